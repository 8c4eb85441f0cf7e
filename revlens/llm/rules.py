"""Quality rules as a bitmask ledger.

Every rule is evaluated once over the whole text.  The ledger keeps one
failure bit for each rule beside the measurements, so that policies (a
version and a mask of rules) are applied later by one bitwise AND, and
ablations ("what would be kept without this rule") by bitwise aggregation
over the distinct masks, without reading a text again.

Defined results: a null text is an empty text (no words); it fails
``too_few_words``.  Repeated rows and repeated ids give one ledger row each.
An empty table gives an empty ledger.  Columns of the input other than the id
and the text are never looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
            ("n_repeat_words", "long"), ("n_lines", "long"), ("n_letters", "long"), ("n_upper", "long"),
            ("n_digits", "long"), ("n_shouted", "long"))

#: Rules in bit order; each is a condition (SQL) on the measurements that holds where the rule fails.
#: Bits are never reused: a new rule gets the next free bit.
RULES = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbol_heavy", "n_words >= 10 AND 10 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    ("mostly_upper", "n_letters >= 20 AND 2 * n_upper > n_letters"),
    ("shouted_words", "n_words >= 10 AND 10 * n_shouted > 2 * n_words"),
    ("digit_heavy", "n_words >= 10 AND 2 * n_digits > word_chars"),
    ("odd_word_length", "n_words >= 10 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    ("few_letters", "n_words >= 10 AND 2 * n_letters < word_chars"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = {p.version: p for p in (
    Policy("base-1", ("too_few_words", "repeated_windows")),
    Policy("web-1", ("too_few_words", "repeated_windows", "symbol_heavy", "repeated_lines", "mostly_upper",
                     "shouted_words")),
    Policy("web-2", tuple(BIT)),
)}
DEFAULT_POLICY = "web-2"


def repeated_window_words(words: list[str], size: int = WINDOW) -> int:
    """Words that stand in a window of ``size`` words found twice or more (exact, without hashing).

    Windows are numbered by pairing: a window of a+b words has the number of
    its first a and of its last b words, packed into one integer.
    """
    n = len(words)
    if n <= size:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    bits = max(1, (len(number) - 1).bit_length())
    rank, have, base = ids, 1, ids
    while have < size:
        m = len(rank) - 1
        if (width := max(1, int(rank.max()).bit_length())) + bits > 62:
            rank = np.unique(rank, return_inverse=True)[1]
            width = max(1, int(rank.max()).bit_length())
        rank = (base[have:have + m] << width) | rank[:m]
        have += 1
    order = np.argsort(rank, kind="stable")
    run = rank[order]
    same = run[1:] == run[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(run), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = order[twice]
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + size, -1)
    return int((np.cumsum(mark[:n]) > 0).sum())


_KEEP_LETTERS = re.compile(r"[\W\d_]+")


def _changed_by_lower(letters: str) -> int:
    """Letters that lower-casing changes."""
    lower = letters.lower()
    if lower == letters:
        return 0
    if len(lower) != len(letters):
        return sum(c != c.lower() for c in letters)
    return int((np.frombuffer(letters.encode("utf-32-le"), np.uint32)
                != np.frombuffer(lower.encode("utf-32-le"), np.uint32)).sum())


def measure(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    dup = 0
    n_lines = 0
    seen: set[str] = set()
    for line in text.split("\n"):
        if WORD.search(line):
            n_lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    letters = _KEEP_LETTERS.sub("", text)
    n_upper = _changed_by_lower(letters)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated_window_words(words),
            n_lines, len(letters), n_upper, sum(map(text.count, "0123456789")),
            sum(w.endswith("!!") for w in words) if "!!" in text else 0)


def _measured(texts: list) -> list:
    return list(zip(*map(measure, texts))) or [[] for _ in MEASURES]


def failure_mask() -> Column:
    """All failure bits as one integer."""
    mask = F.lit(0).cast("long")
    for name, failed in RULES:
        mask = mask + F.when(F.expr(failed), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long"))
    return mask


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row for each document: id, measurements and ``fail_mask`` (a bit for each rule that it fails).

    With ``carry`` the input row comes along as the struct ``row``.
    """
    return map_texts(docs, _measured, MEASURES, id_col, text_col, carry=carry).withColumn("fail_mask", failure_mask())


def apply_policy(ledger: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Adds ``policy`` (the version) and ``kept``: no rule of the policy failed."""
    p = POLICIES[policy]
    return (ledger.withColumn("policy", F.lit(p.version))
            .withColumn("kept", F.col("fail_mask").bitwiseAND(F.lit(p.mask).cast("long")) == 0))


def ablations(ledger: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of the policy: how many documents fail it, fail it alone
    (these come back without the rule), and are kept without it.

    Documents are counted by mask first (at most 2^rules rows leave a task),
    then the rules are tested on the masks.
    """
    p = POLICIES[policy]
    masks = (ledger.groupBy(F.col("fail_mask").bitwiseAND(F.lit(p.mask).cast("long")).alias("m"))
             .agg(F.count("*").alias("n")))
    aggs = [F.sum("n").alias("n_docs"), F.sum(F.when(F.col("m") == 0, F.col("n")).otherwise(0)).alias("n_kept")]
    for r in p.rules:
        bit = F.lit(BIT[r]).cast("long")
        aggs.append(F.sum(F.when(F.col("m").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias(f"fail_{r}"))
        aggs.append(F.sum(F.when(F.col("m") == bit, F.col("n")).otherwise(0)).alias(f"only_{r}"))
    one = masks.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"fail_{r}").alias("n_failed"),
                                        F.col(f"only_{r}").alias("n_failed_only")) for r in p.rules])).alias("x")
    return (one.select("n_docs", "n_kept", rows)
            .select(F.lit(p.version).alias("policy"), "x.rule", "x.n_failed", "x.n_failed_only",
                    (F.col("n_kept") + F.col("x.n_failed_only")).alias("n_kept_without"), "n_kept", "n_docs")
            .filter("n_docs IS NOT NULL"))
