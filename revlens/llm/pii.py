"""Personal data, plain and disguised, with offsets into the source text.

Base spans are found in the text as it stands.  Then transducers rewrite the
text into a normalised one: look-alike letters, digits and signs become their
ASCII forms, invisible characters vanish, runs of spelled digits become digits,
and at/dot disguises ("name [at] host (dot) org", "name at host dot org")
become ``@`` and ``.``.  Time grows with the length of the text, whatever it holds.  Each rewriting keeps, for every character that it
writes, the source range that it came from, so a span that the same detectors
find in the normalised text is mapped back to source characters.

Defined results: a null text is empty and has no span.  A mapped span is added
only if it overlaps no base span of its kind; base spans always stay.  Within a kind
spans do not overlap.  Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

KINDS = ("email", "ip", "card", "phone")

#: Fixed patterns of the base.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost places of local part, @ and dotted domain; each character is read once or twice,
    however long the runs are."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d - 9 if (d := 2 * int(x)) > 9 else d for x in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]


FINDERS = (emails, ips, cards, phones)


def detect(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base spans."""
    return [(a, k, b) for k, find in zip(KINDS, FINDERS) for a, b in find(text)]


#: Fixed look-alikes: character and its ASCII form, by script.
LOOKALIKES = (
    # Cyrillic
    "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT ХX ІI ЈJ ЅS "
    # Greek
    "αa οo ρp νv ιi κk υu ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX "
    # signs
    "․. 。. ﹒. ·. ﹫@ ＠@ ．. ＋+ ﹢+ ‐- ‑- ‒- –- —- −- ﹣- － - （( ）) ［[ ］] ｛{ ｝} ＿_ ％%"
)
#: Whole blocks of digits and letters: first code point, ASCII of the first, how many.
BLOCKS = ((0xFF10, "0", 10), (0xFF21, "A", 26), (0xFF41, "a", 26), (0x1D7CE, "0", 10), (0x1D7D8, "0", 10),
          (0x1D7E2, "0", 10), (0x1D7EC, "0", 10), (0x1D7F6, "0", 10), (0x0660, "0", 10), (0x06F0, "0", 10),
          (0x0966, "0", 10), (0x1D400, "A", 26), (0x1D41A, "a", 26))
#: Characters that print nothing or, the last ones, a space.
INVISIBLE = "­​‌‍⁠﻿"
SPACES = "    　"


def _lookalikes() -> dict[str, str]:
    table = {x[0]: x[1] for x in LOOKALIKES.split() if len(x) == 2}
    table["－"] = "-"
    for first, ascii_first, n in BLOCKS:
        table |= {chr(first + k): chr(ord(ascii_first) + k) for k in range(n)}
    table |= dict.fromkeys(INVISIBLE, "") | dict.fromkeys(SPACES, " ")
    return table


ASCII_OF = _lookalikes()
ODD = re.compile("[" + "".join(map(re.escape, ASCII_OF)) + "]")

#: Fixed words for digits, by language: en, de, fr, es.
DIGIT_WORDS = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
DIGIT_OF = {w: d for d, words in DIGIT_WORDS.items() for w in words.split()}
_DIGIT = "(?:" + "|".join(sorted(DIGIT_OF, key=len, reverse=True)) + ")"
#: At least four spelled digits in a row; digits and signs of a number may stand among them, and between them what phone and
#: card numbers hold.  Every item ends with its word, so a run is read once.
SPELLED = re.compile(rf"(?<![^\W_])(?:(?:plus|\+)[ ]?)?\(?{_DIGIT}(?![^\W_])(?:[ ,.()\-\n]{{1,3}}(?:{_DIGIT}|[0-9]++|dash|dot|point)(?![^\W_])){{3,}}+",
                     re.IGNORECASE)
SPELLED_WORD = re.compile(r"[^\W_]+|\+")
#: An at sign in any guise: in brackets, between underscores or blanks, or the sign itself.
AT = re.compile(r"\[ ?(?:at|@) ?\]|\( ?(?:at|@) ?\)|\{ ?at ?\}|< ?at ?>|_at_|(?<= )at(?= )|@", re.IGNORECASE)
_DOT = (r"(?:[ ]?(?:\[ ?(?:dot|\.) ?\]|\( ?(?:dot|\.) ?\)|\{ ?(?:dot|\.) ?\}|< ?dot ?>|_dot_)[ ]?"
        r"|[ ]+dot[ ]+|\.)")
#: The same, and a local part, from right to left.
_TOD = (r"(?:[ ]?(?:\] ?(?:tod|\.) ?\[|\) ?(?:tod|\.) ?\(|\} ?(?:tod|\.) ?\{|> ?tod ?<|_tod_)[ ]?"
        r"|[ ]+tod[ ]+|\.)")
LOCAL_BACK = re.compile(rf"[A-Za-z0-9_%+-]++(?:{_TOD}[A-Za-z0-9_%+-]++)*+", re.IGNORECASE)
HOST = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++", re.IGNORECASE)
DOT = re.compile(_DOT, re.IGNORECASE)
AT_HINT = re.compile(r"[\[({<_][ ]?(?:at|dot|@|\.)[ ]?[\])}>_]|[ ]dot[ ]|[ ]@|@[ ]", re.IGNORECASE)
#: Fixed endings of hosts that "name at host dot ending" needs, since at and dot are words too.
ENDINGS = frozenset("com org net edu gov mil int info biz io co ai app dev me tv us uk de fr es it nl be ch at eu pl se no dk fi "
                    "pt ie ca au nz in jp cn kr br mx ar ru".split())


class Tape:
    """A text and, for each of its characters, the source range that it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> None:
        """Replace [a, b) by a string, for pieces in order; each new character stands for the piece's whole range."""
        if not pieces:
            return
        text, start, end, at = [], [], [], 0
        for a, b, new in pieces:
            text.append(self.text[at:a])
            start.extend(self.start[at:a])
            end.extend(self.end[at:a])
            text.append(new)
            start.extend([self.start[a]] * len(new))
            end.extend([self.end[b - 1]] * len(new))
            at = b
        text.append(self.text[at:])
        start.extend(self.start[at:])
        end.extend(self.end[at:])
        self.text, self.start, self.end = "".join(text), start, end

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


def _lookalike_pieces(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), ASCII_OF[m[0]]) for m in ODD.finditer(text)]


def _digit_pieces(text: str) -> list[tuple[int, int, str]]:
    """Digits written as words, with what joins them, within each long enough run."""
    pieces = []
    for run in SPELLED.finditer(text):
        at = run.start()
        for m in SPELLED_WORD.finditer(text, run.start(), run.end()):
            w = m[0].lower()
            new = DIGIT_OF.get(w) or {"plus": "+", "dash": "-", "dot": ".", "point": "."}.get(w, m[0])
            pieces.append((at, m.end(), new))  # the joining signs before the word go with it
            at = m.end()
    return pieces


def _at_dot_pieces(text: str) -> list[tuple[int, int, str]]:
    """Signs of disguised addresses.  Each at is taken for itself and extended to both sides, so a character is read
    twice at most, however many marks there are."""
    pieces: list[tuple[int, int, str]] = []
    back, n, free, mark = None, len(text), 0, 0
    for m in AT.finditer(text):
        a, b = m.span()
        if a < free:
            continue
        floor, mark = max(free, mark), b  # no local part reaches over the mark before
        word = m[0].lower() in ("at", "_at_")
        if m[0].lower() == "at":
            while a > floor and text[a - 1] == " ":
                a -= 1
            while b < n and text[b] == " ":
                b += 1
        else:
            a -= a > floor and text[a - 1] == " "
            b += b < n and text[b] == " "
        if back is None:
            back = text[::-1]
        local, host = LOCAL_BACK.match(back, n - a, n - floor), HOST.match(text, b)
        if not local or not host:
            continue
        dots = [d.span() for d in DOT.finditer(text, *host.span())]
        end = host.end()
        if word:  # the host ends with its last known ending; "look at example.com" is ordinary wording
            while dots and text[dots[-1][1]:end].lower() not in ENDINGS:
                end = dots.pop()[0]
            if all(text[x:y] == "." for x, y in dots):
                continue
        kinds = {text[x:y] == "." for x, y in dots}
        if not text[dots[-1][1]:end].isalpha() or end - dots[-1][1] < 2 or (m[0] == "@" and b - a > 1 and len(kinds) > 1):
            continue
        pieces += [(*d.span(), ".") for d in DOT.finditer(text, n - local.end(), a)] + [(a, b, "@")] + [(x, y, ".") for x, y in dots]
        free = end
    return pieces


def disguised(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Spans (start, kind, end) that show only in the normalised text."""
    odd = not text.isascii() and ODD.search(text)
    if not odd and not AT_HINT.search(text) and not SPELLED.search(text):
        return []
    tape = Tape(text)
    if odd:
        tape.rewrite(_lookalike_pieces(tape.text))
    tape.rewrite(_digit_pieces(tape.text))
    tape.rewrite(_at_dot_pieces(tape.text))
    if tape.text == text:
        return []
    found = []
    taken = {k: sorted((a, b) for a, kind, b in base if kind == k) for k in KINDS}  # spans of a kind do not overlap
    last = dict.fromkeys(KINDS, 0)
    for a, k, b in detect(tape.text):  # by kind, from left to right
        a, b = tape.source(a, b)
        at = bisect_left(taken[k], (b, b))  # the base spans that begin before this one ends
        if a >= last[k] and (not at or taken[k][at - 1][1] <= a):
            found.append((a, k, b))
            last[k] = b
    return found


def _order(span: tuple[int, str, int]) -> tuple:
    return span[0], KINDS.index(span[1]), span[2]


def spans_of(text: str | None) -> tuple[list, list]:
    """(base spans, all spans), each (start, kind, end) by start, then kind."""
    text = text or ""
    base = sorted(detect(text), key=_order)
    return base, sorted(base + disguised(text, base), key=_order)


def masked(text: str | None, spans: list[tuple[int, str, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out.append(text[at:a] + f"[{k.upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


FIELDS = (("n_email", "long"), ("n_ip", "long"), ("n_card", "long"), ("n_phone", "long"),
          ("base_spans", "string"), ("spans", "string"), ("n_disguised", "long"))


def _row(text: str | None, with_text: bool) -> tuple:
    base, every = spans_of(text)
    out = (*(sum(s[1] == k for s in base) for k in KINDS), joined(base), joined(every), len(every) - len(base))
    return (*out, masked(text, every)) if with_text else out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
             carry: bool = False) -> DataFrame:
    """One row for each document: counts of the base spans by kind, base spans and all
    spans as ``kind:start:end`` lists, and with ``with_text`` the masked text."""
    fields = (*FIELDS, ("masked_text", "string")) if with_text else FIELDS

    def run(texts: list) -> list:
        return list(zip(*(_row(t, with_text) for t in texts))) or [[] for _ in fields]

    return map_texts(docs, run, fields, id_col, text_col, carry=carry)


def mask_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length_col: str = "n_chars") -> DataFrame:
    """The documents with all spans masked in the text; ``length_col``, where it exists, follows the new text."""
    found = find_pii(docs, id_col, text_col, with_text=True, carry=True)
    new = {text_col: F.col("masked_text").cast(docs.schema[text_col].dataType)}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone")
                                 + F.col("n_disguised") > 0, F.length("masked_text")) \
            .otherwise(F.col(f"row.`{length_col}`")).cast(docs.schema[length_col].dataType)
    return found.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
