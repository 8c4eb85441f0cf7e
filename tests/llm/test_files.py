"""Archives (2), token files (3), packing (8)."""

import struct

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from revlens.llm import packing, rans, warc
from revlens.llm.common import scratch
from revlens.llm.tokens import WordTokenizer, public_path
from tests.llm import brute

ODD = ["", " ", "\n\n", "a  b   c", "don't we'll I'M", "  two  blanks \n x", "a\n  b", "a\n b \nc\n ", "end ", " start",
       "étude café İstanbul straße", "x<|endoftext|>y <|endoftext|> \n<|endoftext|>", "日本語 テキスト，です 123abc 4.5%",
       "a\x1cb \x0b c", "½² ³x ª º 12 34", "!!?? 'quoted' -- \"x\"", "word,foo²bar д", "tab\tsep \r\n line", "'s 't x's ''s",
       "🙂 smile🙂 a", "_a_ b_c", "é äb", "ǅ ﬁ", "﻿x ​ y", "A" * 5000]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_are_the_librarys(name):
    t = WordTokenizer(public_path(name))
    for text in [*ODD, *(r["text"] for r in brute.rows("documents")), *ODD]:
        assert t.encode(text) == brute.ids(t.library, text)[1][:-4], text[:80]


def test_a_word_is_split_once_when_the_chunks_are_full():
    """In any case and with any sign behind it: the model is asked once for a word that the cache of pieces holds."""
    t = WordTokenizer(public_path("word_bpe_49k.json"))
    t.most, asked, split = 0, [], t.pieces.split
    t.pieces.split = lambda word: asked.append(word) or split(word)
    text = "Unheard unheard, UNHEARD! unheard élanvital Élanvital."
    assert t.encode(text) == brute.ids(t.library, text)[1][:-4]
    assert len(t) == 0 and len(asked) == 2


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB é'\n\t ,.1²śдß", max_size=30))
def test_cached_ids_of_any_text(text):
    for t in _tokenizers():
        assert t.encode(text) == brute.ids(t.library, text)[1][:-4]


def _tokenizers(made=[]):
    made or made.extend(WordTokenizer(public_path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    return made


def test_warc_matches_brute_force(spark):
    want = brute.warc(brute.rows("pages"))
    got = entry.queries()["op2_warc_revisits"](spark, brute.SF).collect()
    assert {r.page_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_warc_odd(spark):
    nasty = ["a\r\n\r\nb\r\n", "\r\n\r\n", "\n", "\r", "x\r\n\r", None, "", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc", "é 日", "\x00\x1c"]
    data = [(k, f"http://h/{k} x\n", t, 1) for k, t in enumerate(nasty + nasty)] + [(3, None, "\r", 1), (None, None, "q", 1), (None, "u", "q", 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, payload_bytes int")
    path = scratch(spark, "t")
    warc.deduplicate_archives(pages, path)
    got = warc.read_warc(spark, path, with_payload=True).collect()
    assert len(got) == len(data)
    want = brute.warc([{"page_id": k, "html": t} for k, t in enumerate(nasty + nasty)])
    for r in got:
        if r.page_id is not None:
            assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want[r.page_id]
            if r.record_type == "response":
                assert r.payload.decode() == (nasty[r.page_id] or "")
        else:
            assert r.record_type == "response" and r.refers_to is None
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_warc_without_null_ids_refers_to_the_smallest(spark):
    pages = spark.createDataFrame([(None, "u", "q"), (5, "u", "q")], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.warc_round_trip(pages).collect()}
    assert got[5].record_type == "response" and got[None].record_type == "revisit" and got[None].refers_to == 5


def _table(symbols, scale=12):
    ids, counts = np.unique(symbols, return_counts=True)
    return rans.Table(ids, rans.quantized(ids, counts, scale), scale)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=600), st.integers(1, 17), st.integers(1, 5))
def test_rans_round_trip(ids, lanes, every):
    ids = np.array(ids, np.int64)
    table = _table(ids)
    assert table.freq.sum() == 1 << 12 and (table.freq >= 1).all()
    symbols = np.searchsorted(table.ids, ids)
    data = rans.encode_block(symbols, table, lanes, every)
    slots = table.symbols()
    assert (table.ids[rans.decode_block(data, table, slots)] == ids).all()
    rows = -(-len(ids) // lanes)
    for first in range(rows):  # decoding from a checkpoint gives the same part
        got = rans.decode_block(data, table, slots, first, min(rows, first + 2))
        assert (table.ids[got] == ids[first * lanes:(first + 2) * lanes]).all()


def test_rans_notices_a_damaged_span():
    ids = np.random.default_rng(3).integers(0, 50, 400)
    table = _table(ids)
    data = rans.encode_block(np.searchsorted(table.ids, ids), table, 4, 10)
    hurt = bytearray(data)
    hurt[-1] ^= 1  # the last word of the stream: read in the last rows
    want = rans.decode_block(data, table, table.symbols(), 20, 25)
    assert (rans.decode_block(bytes(hurt), table, table.symbols(), 20, 25) == want).all()
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_block(bytes(hurt), table, table.symbols(), 99)
    for k in range(10, len(data)):  # whatever is hurt, no part is given out wrong
        hurt = bytearray(data)
        hurt[k] ^= 4
        try:
            assert (rans.decode_block(bytes(hurt), table, table.symbols(), 20, 25) == want).all()
        except (ValueError, IndexError, struct.error, OverflowError, MemoryError):
            pass


def test_rans_one_symbol_and_size():
    ids = np.zeros(10_000, np.int64)
    table = _table(ids)
    assert len(rans.encode_block(ids, table, 8, 10_000)) < 200
    rng = np.random.default_rng(1)
    ids = rng.geometric(0.3, 100_000)
    table = _table(ids, 16)
    p = np.bincount(ids)[1:] / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert len(rans.encode_block(np.searchsorted(table.ids, ids), table, 64)) < 1.02 * entropy + 10_000


def test_token_file_matches_brute_force(spark):
    library = WordTokenizer(public_path("word_bpe_49k.json")).library
    start, want = 0, {}
    for r in sorted(brute.rows("documents"), key=lambda r: r["doc_id"]):
        x, _ = brute.ids(library, r["text"])
        want[r["doc_id"]] = (start, len(x), brute.crc(x))
        start += len(x)
    got = entry.queries()["op3_rans_tokens"](spark, brute.SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_token_file_odd(spark):
    data = [(k, t, 7) for k, t in enumerate([*ODD, None])] + [(3, ODD[3], 7), (None, "z", 7)]
    docs = spark.createDataFrame(data, "doc_id long, text string, start int").repartition(5)
    path = scratch(spark, "t")
    rans.write_token_file(docs, path, lanes=4, block_ids=50, check_rows=3)
    got = rans.read_token_file(spark, path, with_ids=True).collect()
    library = WordTokenizer(public_path("word_bpe_49k.json")).library
    assert len(got) == len(data)
    for r in got:
        text = "z" if r.doc_id is None else dict((a, b) for a, b, _ in data)[r.doc_id]
        assert r.ids == brute.ids(library, text)[1]
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    assert rans.token_file_round_trip(docs.limit(0)).count() == 0


def test_token_file_notices_damage(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    path = scratch(spark, "t")
    rans.write_token_file(docs, path, lanes=2)
    blocks = spark.read.parquet(f"{path}/blocks").toPandas()
    blocks["crc32"] ^= 1
    broken = scratch(spark, "t")
    spark.createDataFrame(blocks, spark.read.parquet(f"{path}/blocks").schema).write.parquet(f"{broken}/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{broken}/table")
    with pytest.raises(Exception, match="damaged"):
        rans.read_token_file(spark, broken).collect()


def check_packing(rows, want, capacity=1024):
    """rows: packed pieces; want: doc_id -> ids (a list for repeated ids)."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for at in by_sequence.values():
        at.sort(key=lambda r: r.offset)
        place = 0
        for r in at:
            assert r.offset == place
            place += r.length
        assert place <= capacity
    for doc, x in want.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        place = 0
        for r in pieces:
            assert r.start == place and r.ids_crc32 == brute.crc(x[place:place + r.length])
            place += r.length
        assert place == len(x)
        assert all(r.length == capacity for r in pieces[1:]) and (len(x) > capacity or len(pieces) == 1)
    return len(by_sequence)


def test_packing_matches_brute_force(spark):
    library = WordTokenizer(public_path("byte_bpe_50k.json")).library
    want = {r["doc_id"]: brute.ids(library, r["text"])[0] for r in brute.rows("documents")}
    rows = entry.queries()["op8_best_fit_packing"](spark, brute.SF).collect()
    n = check_packing(rows, want)
    lengths = sorted((r.length for r in rows), reverse=True)
    bins = []  # best fit decreasing over the pieces themselves
    for x in lengths:
        fits = [k for k, room in enumerate(bins) if room >= x]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= x
        else:
            bins.append(1024 - x)
    assert n == len(bins)


@settings(max_examples=300, deadline=None)
@example({5: 4, 7: 22, 32: 12})
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
def test_plan_places_every_piece_once(counts):
    runs = packing.plan_runs(counts, 50)
    seen, used = {}, {}
    for length, rank, number, sequence, offset in runs:
        for k in range(number):
            assert (length, rank + k) not in seen
            seen[length, rank + k] = 1
            used.setdefault(sequence + k, []).append((offset, length))
    assert len(seen) == sum(counts.values())
    for at in used.values():
        place = 0
        for offset, length in sorted(at):
            assert offset == place
            place += length
        assert place <= 50
    bins = []
    for x in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [k for k, room in enumerate(bins) if room >= x]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= x
        else:
            bins.append(50 - x)
    assert len(used) == len(bins)


def test_packing_odd(spark):
    data = [(k, t, 7) for k, t in enumerate([*ODD, None])] + [(None, "z", 7)]
    docs = spark.createDataFrame(data, "doc_id long, text string, length int")
    library = WordTokenizer(public_path("byte_bpe_50k.json")).library
    rows = packing.pack_best_fit(docs, with_ids=True).collect()
    check_packing(rows, {d: brute.ids(library, t)[0] for d, t, _ in data})
    assert packing.pack_best_fit(docs.union(docs)).count() == 2 * len(rows)
    assert packing.pack_best_fit(docs.limit(0)).count() == 0
