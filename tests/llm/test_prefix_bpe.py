"""Byte-level BPE by prefixes (12) against the tiktoken library."""

import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from revlens.llm import prefix_bpe
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Letters, digits, signs, all kinds of white space, joiners and characters of several bytes.
ALPHABET = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0    　﻿​'aestvlxoABZ019.,!_é²½Ⅷ٠日本😀́"
TEXT = st.text(st.sampled_from(ALPHABET), max_size=50) | st.text(max_size=20)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def row(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_matches_the_library(spark, library):
    want = {r["doc_id"]: row(library, r["text"]) for r in brute.rows("documents")}
    got = entry.queries()["op12_prefix_bpe"](spark, brute.SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_odd_rows(spark, library):
    texts = [None, "", " ", " \n ", "x" * 50_000, "ab" * 30_000, " " * 20_000, "日本" * 10_000, "a  b\n\n c\x1cd", "a b", "a b"]
    data = [(k, t, "z", 1) for k, t in enumerate(texts)] + [(None, "a b", "z", 1), (3, "a b", None, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids_sha256 string, n_tokens int")
    got = prefix_bpe.round_trip(docs).collect()
    want = sorted(((k, *row(library, t)) for k, t, _, _ in data), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert prefix_bpe.round_trip(docs.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_any_text(text):
    own, lib = prefix_bpe.encoder(PATH), _library()
    ids = lib.encode_ordinary(text)
    assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert own.decode(own.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8), TEXT), max_size=3))
def test_edits_and_appends(text, edits):
    own, lib = prefix_bpe.encoder(PATH), _library()
    held = prefix_bpe.PrefixText(own, text)
    for at, n, new in edits:
        at = min(at, len(held.text))
        want = held.text[:at] + new + held.text[at + n:]
        held.edit(at, min(at + n, len(held.text)), new)
        assert held.text == want and held.ids() == lib.encode_ordinary(want)
    held.append(text)
    assert held.ids() == lib.encode_ordinary(held.text)


def test_an_edit_works_near_the_edit(library):
    for text in ("ing the " * 20_000, "abcde" * 20_000, "one\ntwo  three " * 5_000):
        held = prefix_bpe.PrefixText(prefix_bpe.encoder(PATH), text)
        assert held.worked >= len(text) - 1
        held.edit(50_000, 50_003, "xyz")
        assert held.worked < 500 and held.ids() == library.encode_ordinary(held.text)
        held.append("more")
        assert held.worked < 500 and held.ids() == library.encode_ordinary(held.text)


def test_every_prefix_of_a_piece(library):
    own = prefix_bpe.encoder(PATH)
    for piece in (" internationalisation", "zzzzzzzzzzzzzzzzzzzz", " ñandúes", "aaaaaabaaaabaaabab"):
        table = prefix_bpe.Prefixes(own.vocabulary, piece.encode())
        for n in range(len(piece.encode()) + 1):
            assert table.ids(n) == (library._core_bpe.encode_single_piece(piece.encode()[:n]) if n else [])


def test_stored_tables_and_appended_documents(spark, library):
    data = [(k, t, m) for k, (t, m) in enumerate([("some text", "s of mine"), (None, "a"), ("b ", None), ("x\n", "\ny"), ("", "")])]
    docs = spark.createDataFrame(data, "doc_id long, text string, more string")
    own = prefix_bpe.encoder(PATH)
    for r in prefix_bpe.prefix_tables(docs).collect():
        text = data[r.doc_id][1] or ""
        assert prefix_bpe.ids_of_prefix(own, r["last"]) == library.encode_ordinary(text)
    got = {r.doc_id: r.ids for r in prefix_bpe.append_documents(docs).collect()}
    for k, text, more in data:
        ids = library.encode_ordinary((text or "") + (more or ""))
        assert got[k] == struct.pack(f"<{len(ids)}I", *ids)


_LIBRARY = []


def _library():
    if not _LIBRARY:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
        _LIBRARY.append(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _LIBRARY[0]
