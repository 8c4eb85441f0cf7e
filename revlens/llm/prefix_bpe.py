"""Byte-level BPE by dynamic programming over byte prefixes.

For every byte prefix of a piece there is exactly one token that can end its encoding: of the
vocabulary's tokens that end there, the one which the merges leave beside the last token of the
prefix before it.  ``last`` keeps that token for every prefix, so

- the ids of any prefix are read off backwards, without merging anything again;
- an append goes on where the table ends;
- after an edit the table is rebuilt from the edit on, until it agrees with the old one over
  the length of the longest token; from there the old table holds.

Whether two tokens may stand side by side is found by taking both apart at the border in the
reverse order of the merges: the pair stands unless some pair across the border would have
been merged earlier.  Answers are kept, as pairs repeat.

A text is first cut into pieces by the pattern that the rank files are made for, and each piece is
encoded on its own.  Text without white space other than blanks between words is cut at the blanks
and the pieces of such a chunk are kept in a bounded cache of the worker; the ids are those of the
whole text (tests compare with the tiktoken library).

Defined results: a null text is empty; an empty text has no ids and the digests of nothing; every row is
encoded on its own, so repeated rows, null ids and columns with other names change nothing; an
empty table gives no row.  The work grows with the length of a text, also within one very long piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import threading
from array import array
from bisect import bisect_right

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_texts
from .tokens import public_path

#: Chunks, pieces and pairs that a worker keeps; longer chunks and pieces are not kept.
CACHE_CHUNKS, CACHE_PIECES, CACHE_PAIRS, CACHE_LENGTH = 600_000, 600_000, 4_000_000, 48
#: Control characters that `str.isspace` takes for white space and Unicode's White_Space does not.
NOT_SPACES = re.compile("[\x1c-\x1f]")
SPACES = r"\t-\r\x20\x85\xa0  -     　"
#: A run of white space and the run of other characters after it.
CHUNK = re.compile(rf"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
PLAIN_BREAKS = re.compile(r"  | \n|\n |\n\n|[ \n]\Z|[^\S \n]")


def public_pattern() -> str:
    from public_tokenizers import PATTERN
    return PATTERN


class Vocabulary:
    """Tokens by rank, with the pair each one was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.split: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        self.ends = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            parts = self._merged(token, rank)
            if len(token) > 1 and len(parts) != 2:
                continue  # no merge makes it, so no encoding holds it
            if len(token) > 1:
                self.split[rank] = (ranks[parts[0]], ranks[parts[1]])
            self.ends.add_word(token.decode("latin-1"), (len(token), rank))
        self.ends.make_automaton()

    def _merged(self, token: bytes, below: int) -> list[bytes]:
        """The token's bytes after all merges of lower rank (the vocabulary's definition, for short strings)."""
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, below), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, at = min(found)
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, left: int, right: int) -> bool:
        """True if the merges leave these two tokens side by side."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            known = self._beside(left, right)
            if len(self.pairs) < CACHE_PAIRS:
                self.pairs[key] = known
        return known

    def _beside(self, a: int, b: int) -> bool:
        # Merges are undone from the last one.  Of two merges at the border the one of higher rank came later;
        # between merges of the same rank the left one comes first.  A pair across the border is merged before
        # an undone part was made if its rank is lower, and on the right also if it is the same.
        before = 1 << 62
        while True:
            made = self.ranks.get(self.tokens[a] + self.tokens[b])
            if made is not None and made < before:
                return False
            if a not in self.split and b not in self.split:
                return True
            if b not in self.split or (a in self.split and a > b):
                before, a = a, self.split[a][1]
            else:
                before, b = b + 1, self.split[b][0]

    def ids(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        n, tokens, pairs = len(data), self.tokens, self.pairs
        last = [0] * n
        at = -1
        for end, (length, rank) in self.ends.iter(data.decode("latin-1")):
            if end == at:
                continue  # a prefix has one last token
            if length <= end:
                left = last[end - length]
                ok = pairs.get(left << 32 | rank)
                if ok is None:
                    ok = self.beside(left, rank)
                if not ok:
                    continue
            last[end] = rank
            at = end
        out = []
        while n:
            out.append(last[n - 1])
            n -= len(tokens[out[-1]])
        return out[::-1]


class Prefixes:
    """The table of one piece: ``last[k]`` is the token that ends the encoding of its first k + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last = array("I")
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exactly the table of the longer piece; only prefixes that end in ``more`` are worked out."""
        begin = len(self.data)
        self.data += more
        self._extend(self.last, self.data, begin)

    def _extend(self, last: array, data: bytes, begin: int, until=None) -> int:
        """Entries from ``begin`` on, until the end or ``until(k)``; returns where it ended."""
        v = self.vocabulary
        beside, tokens = v.beside, v.tokens
        back = max(0, begin - v.longest)
        at = -1
        for end, (length, rank) in v.ends.iter(data[back:].decode("latin-1")):
            end += back
            if end < begin or end == at or length > end + 1:
                continue
            start = end + 1 - length
            if start < back or (start and not beside(last[start - 1], rank)):
                continue
            at = end
            last.append(rank)
            if until is not None and until(end):
                return end + 1
        if at + 1 < len(data) and begin < len(data):
            raise AssertionError(f"no token of {len(tokens)} ends after byte {at + 1}")
        return len(data)

    def ids(self, length: int | None = None) -> list[int]:
        """Ids of the first ``length`` bytes (all of them)."""
        at, out, tokens = len(self.data) if length is None else length, [], self.vocabulary.tokens
        while at:
            out.append(self.last[at - 1])
            at -= len(tokens[out[-1]])
        return out[::-1]

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace the bytes start to end; returns how many entries were worked out anew."""
        old, shift = self.last, len(new) - (end - start)
        data = self.data[:start] + new + self.data[end:]
        made = array("I", old[:start])
        same, longest = 0, self.vocabulary.longest

        def agrees(k: int) -> bool:
            nonlocal same
            same = same + 1 if k >= start + len(new) and made[k] == old[k - shift] else 0
            return same >= longest

        until = self._extend(made, data, start, agrees)
        self.data, self.last = data, made + old[until - shift:]
        return until - start


class Encoder(dict):
    """Chunk (blank and what stands up to the next blank) to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        #: the public pattern cuts before white space that follows other characters; of another one nothing is known
        self.public = pattern == public_pattern()
        self.bytes_of = [self.vocabulary.tokens.get(k, b"") for k in range(max(self.vocabulary.tokens) + 1)]

    def _piece(self, piece: str) -> bytes:
        made = self.pieces.get(piece)
        if made is None:
            ids = self.vocabulary.ids(piece.encode("utf-8", "replace"))
            made = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.pieces) < CACHE_PIECES and len(piece) <= CACHE_LENGTH:
                self.pieces[piece] = made
        return made

    def _cut(self, text: str) -> bytes:
        if self.public and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self._piece(text)  # letters are one piece, with the blank before them
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def __missing__(self, chunk: str) -> bytes:
        made = self._cut(chunk)
        if len(self) < CACHE_CHUNKS and len(chunk) <= CACHE_LENGTH:
            self[chunk] = made
        return made

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text."""
        if not text:
            return b""
        if not self.public or NOT_SPACES.search(text):
            return self._cut(text)
        if PLAIN_BREAKS.search(text):
            return b"".join(map(self.__getitem__, CHUNK.findall(text)))
        first, *rest = text.split(" ")
        return self[first] + b"".join([self[" " + x] for x in rest])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class PrefixText:
    """A text with the tables of its pieces: appends and edits keep what lies before and behind them.

    ``worked`` is the number of table entries that the last change made anew.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.text = ""
        self.starts: list[int] = []  # characters
        self.tables: list[Prefixes] = []
        self.worked = 0
        self.edit(0, 0, text)

    def ids(self) -> list[int]:
        return [i for t in self.tables for i in t.ids()]

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters start to end.

        Pieces are cut again from the chunk before the edit on, until a chunk begins behind the edit where one
        began before.  A piece that goes on from the same place keeps the table's beginning.
        """
        old = self.text
        text = old[:start] + new + old[end:]
        self.worked, shift = 0, len(new) - (end - start)
        # white space before a word belongs to the word's chunk; control characters are left to the pattern as they are
        exact = self.encoder.public and not NOT_SPACES.search(text) and not NOT_SPACES.search(old)
        begin = self._chunk_start(old, start) if exact else 0
        first = bisect_right(self.starts, begin - 1) if begin else 0
        known = dict(zip(self.starts[first:], self.tables[first:]))  # each table goes on in one place at most
        before = set(known)
        starts, tables = self.starts[:first], self.tables[:first]
        at, rest = begin, len(self.starts)
        while at < len(text):
            if exact and at >= start + len(new) and at - shift in before \
                    and self._is_chunk(old, at - shift) and self._is_chunk(text, at):
                rest = bisect_right(self.starts, at - shift) - 1
                break
            chunk = CHUNK.match(text, at)[0] if exact else text[at:]
            for piece in self.encoder.pattern.findall(chunk):
                starts.append(at)
                tables.append(self._table(known.pop(at if at < start else at - shift, None), piece))
                at += len(piece)
        self.starts = starts + [s + shift for s in self.starts[rest:]] if at < len(text) else starts
        self.tables = tables + self.tables[rest:] if at < len(text) else tables
        self.text = text

    @staticmethod
    def _chunk_start(text: str, at: int) -> int:
        """Start of the chunk that holds the character before ``at``; the white space before it may change with it."""
        while at and not text[at - 1].isspace():
            at -= 1
        while at and text[at - 1].isspace():
            at -= 1
        return at

    @staticmethod
    def _is_chunk(text: str, at: int) -> bool:
        return at == 0 or at == len(text) or (text[at].isspace() and not text[at - 1].isspace())

    def _table(self, known: Prefixes | None, piece: str) -> Prefixes:
        data = piece.encode("utf-8", "replace")
        if known is None:
            self.worked += len(data)
            return Prefixes(self.encoder.vocabulary, data)
        if known.data == data:
            return known
        low = _common(known.data, data)
        high = min(_common(known.data[::-1], data[::-1]), len(data) - low, len(known.data) - low)
        self.worked += known.edit(low, len(known.data) - high, data[low:len(data) - high])
        return known


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(x.argmax()) if x.any() else n


_LOADED: dict[tuple[str, str], Encoder] = {}
_LOCK = threading.Lock()


def encoder(path: str, pattern: str | None = None) -> Encoder:
    """The worker's encoder for a rank file (loaded once in a worker); the pattern is that of the public files."""
    pattern = pattern or public_pattern()
    with _LOCK:
        if (path, pattern) not in _LOADED:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _LOADED[path, pattern] = Encoder(ranks, pattern)
        return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id",
                     text_col: str = "text", pattern: str | None = None) -> DataFrame:
    """id and ``ids``: the whole text's ids as little-endian unsigned 32-bit integers."""
    def run(texts: list) -> tuple[list]:
        return ([encoder(public_path(ranks), pattern).encode(t) for t in texts],)

    return map_texts(docs, run, [("ids", "binary")], id_col, text_col)


def round_trip(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text",
               pattern: str | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256 (the decoded bytes)."""
    def run(texts: list) -> tuple[list, list, list]:
        own = encoder(public_path(ranks), pattern)
        coded = [own.encode(t) for t in texts]
        return ([len(x) // 4 for x in coded], [hashlib.sha256(x).hexdigest() for x in coded],
                [hashlib.sha256(own.decode(x)).hexdigest() for x in coded])

    return map_texts(docs, run, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
                     id_col, text_col)


def prefix_tables(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text",
                  pattern: str | None = None) -> DataFrame:
    """id and ``last``: for every byte prefix of the text the token that ends its encoding (unsigned 32-bit,
    little-endian; a piece's entries follow those of the piece before).  ``ids_of_prefix`` reads ids off it."""
    def run(texts: list) -> tuple[list]:
        own = encoder(public_path(ranks), pattern)
        return ([b"".join(t.last.tobytes() for t in PrefixText(own, x or "").tables) for x in texts],)

    return map_texts(docs, run, [("last", "binary")], id_col, text_col)


def ids_of_prefix(own: Encoder, last: bytes, length: int | None = None) -> list[int]:
    """Ids of the first ``length`` bytes of a text from its stored table, if a piece ends there or goes on."""
    table, out = np.frombuffer(last, "<u4"), []
    at = len(table) if length is None else length
    while at:
        out.append(int(table[at - 1]))
        at -= len(own.bytes_of[out[-1]])
    return out[::-1]


def append_documents(docs: DataFrame, ranks: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id",
                     text_col: str = "text", more_col: str = "more", pattern: str | None = None) -> DataFrame:
    """id, ``ids`` of text and appended text together, ``worked`` (table entries that the append made)."""
    from pyspark.sql import functions as F
    pair = docs.select(F.col(f"`{id_col}`").alias(id_col), F.to_json(F.struct(
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("a"), F.coalesce(F.col(f"`{more_col}`"), F.lit("")).alias("b"))).alias("both"))

    def run(texts: list) -> tuple[list, list]:
        import json
        own, ids, worked = encoder(public_path(ranks), pattern), [], []
        for x in texts:
            x = json.loads(x)
            held = PrefixText(own, x["a"])
            held.append(x["b"])
            made = held.ids()
            ids.append(struct.pack(f"<{len(made)}I", *made))
            worked.append(held.worked)
        return ids, worked

    return map_texts(pair, run, [("ids", "binary"), ("worked", "long")], id_col, "both")
