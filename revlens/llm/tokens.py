"""Token ids of whole texts by a public tokenizer file, with a word cache.

A byte-pair tokenizer cuts a text into pieces by a pattern that never looks
back, and treats each piece alike wherever it stands.  So the plain pieces
(words of Latin letters, digits, ASCII signs) are cut here, and their ids are
looked up in a bounded cache of the worker; a plain word that is not in it
goes to the library's model.  All else - from the first character that is not
plain to the next white space - goes to the library as it is, and a text with
unusual white space or a special token as a whole, so the ids are always those of the whole text
(tests compare them).
"""

from __future__ import annotations

import re
import struct
import threading

import pyarrow as pa
from tokenizers import Tokenizer

#: White space other than blank, tab, line feed and carriage return.
OTHER_SPACES = [c for c in map(chr, (*range(0x0B, 0x0D), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E,
                                     *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF))]

_LETTERS = r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[\x00-\x7F]|\Z)"
_SIGNS = r"[!-&(-/:-@\[-`{-~]++(?=[ \t\n\rA-Za-z0-9]|\Z)"
#: The plain pieces by kind of tokenizer: with the blank before them, or without any white space.
PIECES = {
    "byte": re.compile(rf"[ ]?{_LETTERS}|[ ]?{_SIGNS}|\n(?=[^ \t\n\r])|[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+\Z"),
    "word": re.compile(rf"{_LETTERS}|{_SIGNS}|[^ \t\n\r]+"),
}
PLAIN_WORD = re.compile(r"[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")
#: What stands between blanks most often: a word, with a sign behind it or without.
WORD_AND_SIGN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)\Z")

#: Entries that a worker's two caches hold; the first ones stay, which are mostly the frequent ones.
CACHE_PIECES, CACHE_CHUNKS = 600_000, 300_000
#: The same for a tokenizer that lower-cases.  There words are kept as pieces too, so a word in other case or with
#: another sign is known even when the cache of chunks is full.
LOWER_PIECES, LOWER_CHUNKS = 1_000_000, 800_000
#: Longer pieces are not kept.
CACHE_LENGTH = 40


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is a visible
    Latin-1 character, else the next free one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


BYTE_LETTERS = dict(enumerate(_byte_letters()))


_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return _PACK[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Plain piece to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, library: Tokenizer, lower: bool):
        super().__init__()
        self.library, self.lower, self.split = library, lower, library.model.tokenize
        self.most = LOWER_PIECES if lower else CACHE_PIECES

    def word(self, letters: str) -> bytes:
        """Ids of a run of plain letters, after a blank if the tokenizer keeps blanks."""
        if self.lower:
            letters = letters.lower()
            if (made := self.get(letters)) is not None:
                return made
        plain = letters
        if not letters.isascii():  # ASCII letters stand for themselves
            plain = letters.encode().decode("latin-1").translate(BYTE_LETTERS)
        made = _packed([t.id for t in self.split(plain if self.lower else BYTE_LETTERS[32] + plain)])
        if self.lower:
            self.keep(letters, made)
        return made

    def keep(self, piece: str, made: bytes) -> None:
        if len(self) < self.most and len(piece) <= CACHE_LENGTH:
            self[piece] = made

    def __missing__(self, piece: str) -> bytes:
        if PLAIN_WORD.match(piece):
            word = piece.lower() if self.lower else piece
            made = _packed([t.id for t in self.split(word.encode().decode("latin-1").translate(BYTE_LETTERS))])
        else:
            made = _packed(self.library.encode(piece, add_special_tokens=False).ids)
        self.keep(piece, made)
        return made


class WordTokenizer(dict):
    """Cache of what stands between two blanks (with the blank before it), over the cache of its pieces."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.library = Tokenizer.from_file(path)
        #: a tokenizer that rewrites texts first (white space, case) keeps no blank before a word
        self.blanks = self.library.normalizer is None
        self.most = CACHE_CHUNKS if self.blanks else LOWER_CHUNKS
        self.find = PIECES["byte" if self.blanks else "word"].findall
        self.pieces = _Pieces(self.library, lower=not self.blanks)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def _by_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def __missing__(self, chunk: str) -> bytes:
        if m := WORD_AND_SIGN.match(chunk):
            word = self.__getitem__ if self.blanks and m[2] else self.pieces.word
            made = word(m[1]) + self.pieces[m[2]] if m[2] else word(chunk)
        else:
            made = self._by_pieces(" " + chunk if self.blanks else chunk)
        if len(self) < self.most and len(chunk) <= CACHE_LENGTH:
            self[chunk] = made
        return made

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text."""
        text = text or ""
        if any(c in text for c in OTHER_SPACES) or any(a in text for a in self.added):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return _packed(ids)
        if not self.blanks:
            return b"".join(map(self.__getitem__, text.split()))
        if "  " in text or text[-1:] == " ":  # white space of several characters is one piece
            return self._by_pieces(text)
        first, *rest = text.split(" ")
        return self._by_pieces(first) + b"".join(map(self.__getitem__, rest))


_LOADED: dict[str, WordTokenizer] = {}
_LOCK = threading.Lock()


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for this file (loaded once in a worker)."""
    with _LOCK:
        if path not in _LOADED:
            _LOADED[path] = WordTokenizer(path)
        return _LOADED[path]


def public_path(name: str) -> str:
    """Place of a public tokenizer file on this machine; a path is its own place."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def binary_array(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
