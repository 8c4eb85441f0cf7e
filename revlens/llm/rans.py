"""Token files coded by a static range asymmetric numeral system (rANS).

Ids of all documents, in ascending doc_id order, are coded with one frequency
table for the whole corpus, in blocks that are independent of each other.  A
block interleaves many coder states (lanes): symbol ``i`` belongs to lane
``i mod lanes``, so a step of the coder handles a whole row of lanes at once.
A block holds whole documents, its counts, the final states, checkpoints
(states and stream position before every so-many rows, from which decoding
may start), a CRC-32 for the span of each checkpoint, which every decoder compares,
and a CRC-32 of all its ids, which the reader compares.

The container is a Parquet table with one row for each block (range of
documents, counts, CRC-32 and the coded bytes), which Spark commits, splits and prunes;
the frequency table is a second small one.  The coded bytes are:

    magic "RANS", version, lanes, rows between checkpoints, symbols, words, checkpoints   (u32 each but the magic)
    CRC-32 of the symbols of each span of rows between checkpoints (u32 each)
    checkpoints: stream position (u32), states (u64 for each lane)
    states of all lanes (u64), stream (u32 words)

Defined results: a null text has the end id only.  Repeated doc_ids stand
next to each other, by the order of their ids' bytes; a null doc_id comes first.
An empty table gives an empty file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, scratch, stored
from .tokens import public_path, tokenizer

END_ID = 2
#: Frequencies add up to 2^SCALE; states are kept in [2^31, 2^63) and shed 32 bits at a time.
SCALE = 20
LOW = np.uint64(1 << 31)
LANES = 2048
BLOCK_IDS = 1 << 19
CHECK_ROWS = 128
HEAD = struct.Struct("<4s6I")


def quantized(ids: np.ndarray, counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies (at least 1 each) that add up to 2^scale, in the order of ``ids``."""
    total = 1 << scale
    if len(ids) > total:
        raise ValueError(f"{len(ids)} different ids do not fit into 2^{scale} slots")
    share = counts / counts.sum() * (total - len(ids))
    freq = 1 + np.floor(share).astype(np.int64)
    rest = total - int(freq.sum())
    freq[np.argsort(-(share - np.floor(share)), kind="stable")[:rest]] += 1
    return freq


class Table:
    """Shared frequency table: ids (ascending), their frequencies, first slots, and the symbol of each slot."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, scale: int = SCALE):
        self.scale, self.ids = scale, ids.astype(np.uint32)
        self.freq = freq.astype(np.uint64)
        self.first = (np.cumsum(freq) - freq).astype(np.uint64)

    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids), dtype=np.uint32), self.freq.astype(np.int64))


def encode_block(symbols: np.ndarray, table: Table, lanes: int = LANES, check_rows: int = CHECK_ROWS) -> bytes:
    """Code positions in the table (not ids); the last row may be short."""
    n = len(symbols)
    state = np.full(lanes, LOW, np.uint64)
    rows = -(-n // lanes)
    words: list[np.ndarray] = []  # by row, from the last to the first
    checks: dict[int, tuple[int, np.ndarray]] = {}  # row -> (words so far, states when this row is next to decode)
    shift, scale = np.uint64(32), np.uint64(table.scale)
    limit = np.uint64(63 - table.scale)
    n_words = 0
    freq, first = table.freq[symbols], table.first[symbols]
    for row in range(rows - 1, -1, -1):
        f, c = freq[row * lanes:(row + 1) * lanes], first[row * lanes:(row + 1) * lanes]
        s = state[:len(f)]
        full = s >= (f << limit)
        if full.any():
            words.append((s[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            n_words += len(words[-1])
            s = np.where(full, s >> shift, s)
        q = s // f
        state[:len(f)] = (q << scale) + (s - q * f) + c
        if row % check_rows == 0 and row:
            checks[row] = (n_words, state.copy())
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    step, coded = check_rows * lanes, symbols.astype("<u4")
    spans = [zlib.crc32(coded[at:at + step].tobytes()) for at in range(0, n, step)]
    out = [HEAD.pack(b"RANS", 2, lanes, check_rows, n, n_words, len(checks)), struct.pack(f"<{len(spans)}I", *spans)]
    for row in sorted(checks):
        at, states = checks[row]
        out += [struct.pack("<I", n_words - at), states.astype("<u8").tobytes()]
    return b"".join([*out, state.astype("<u8").tobytes(), stream.astype("<u4").tobytes()])


def decode_block(data: bytes, table: Table, slots: np.ndarray, first_row: int = 0,
                 last_row: int | None = None) -> np.ndarray:
    """Positions in the table of rows first_row..last_row (exclusive).  Decoding runs over whole spans, from the
    checkpoint at or before the first row, and compares each span's CRC-32."""
    magic, version, lanes, check_rows, n, n_words, n_checks = HEAD.unpack_from(data)
    if magic != b"RANS" or version != 2:
        raise ValueError("not a block of token ids")
    rows = -(-n // lanes)
    n_spans, size = -(-rows // check_rows), 4 + 8 * lanes
    spans = struct.unpack_from(f"<{n_spans}I", data, HEAD.size)
    checks = HEAD.size + 4 * n_spans
    at = checks + n_checks * size
    state = np.frombuffer(data, "<u8", lanes, at).astype(np.uint64)
    stream = np.frombuffer(data, "<u4", n_words, at + 8 * lanes).astype(np.uint64)
    last_row = rows if last_row is None else min(rows, last_row)
    end = min(rows, -(-last_row // check_rows) * check_rows)
    row = pos = 0
    if k := min(first_row // check_rows, n_checks):
        at = checks + (k - 1) * size
        pos, row = struct.unpack_from("<I", data, at)[0], k * check_rows
        state = np.frombuffer(data, "<u8", lanes, at + 4).astype(np.uint64)
    out = np.empty(max(0, min(n, end * lanes) - row * lanes), "<u4")
    begin, base = row, row * lanes
    mask, scale, shift = np.uint64((1 << table.scale) - 1), np.uint64(table.scale), np.uint64(32)
    while row < end:
        width = min(lanes, n - row * lanes)
        s = state[:width]
        slot = s & mask
        symbol = slots[slot]
        out[row * lanes - base:row * lanes - base + width] = symbol
        s = table.freq[symbol] * (s >> scale) + slot - table.first[symbol]
        low = s < LOW
        if k := int(low.sum()):
            s[low] = (s[low] << shift) | stream[pos:pos + k]
            pos += k
        state[:width] = s
        row += 1
    for k in range(begin // check_rows, n_spans if end == rows else end // check_rows):
        at = k * check_rows * lanes - base
        if zlib.crc32(out[at:at + check_rows * lanes].tobytes()) != spans[k]:
            raise ValueError("a block of token ids is damaged")
    return out[max(0, first_row * lanes - base):max(0, last_row * lanes - base)]


def id_type_of(tokenizer_path: str, end_id: int = END_ID) -> str:
    """The narrowest little-endian type that holds all ids: 16 bits halve what is stored and shuffled."""
    most = max(tokenizer(tokenizer_path).library.get_vocab_size(with_added_tokens=True), end_id + 1)
    return "<u2" if most <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (of ``id_type_of``, with the end id) of whole texts.  Each task ends with a row that has only
    ``counts``: how often each id occurs in its rows (64 bits each)."""
    end, width = int(end_id).to_bytes(4, "little"), id_type_of(tokenizer_path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts, id_type = tokenizer(tokenizer_path).encode, np.zeros(0, np.int64), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [encode(t) + end for t in part.column(1).to_pylist()]
                whole = np.frombuffer(b"".join(ids), "<u4")
                own = np.bincount(whole, minlength=len(counts))
                own[:len(counts)] += counts
                counts = own
                ends = np.cumsum([len(x) // 4 for x in ids])
                small = np.dtype(width).itemsize
                offsets = pa.array(np.concatenate([[0], ends]) * small, pa.int32())  # a slice is bounded by its batch
                coded = pa.Array.from_buffers(pa.binary(), len(ids), [None, offsets.buffers()[1], pa.py_buffer(whole.astype(width).tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends, prepend=0)), coded,
                                                  pa.nulls(len(ids), pa.binary())], names)
        if id_type is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([counts.astype("<i8").tobytes()], pa.binary())], names)

    names = ["doc_id", "n_tokens", "ids", "counts"]
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")) \
        .transform(arrow_map, run, schema)


def frequency_table(tokens: DataFrame, scale: int = SCALE) -> Table:
    """Table of all ids of the corpus from the tasks' counts; the driver gets the vocabulary (tens of thousands of
    rows, whatever the corpus)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                own = np.frombuffer(x, "<i8")
                some = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some])], ["id", "n"])

    rows = (tokens.filter("counts IS NOT NULL").select("counts").transform(arrow_map, run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values("id"))
    ids, counts = rows["id"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    return Table(ids, quantized(ids, counts, scale) if len(ids) else np.zeros(0, np.int64), scale)


def write_token_file(docs: DataFrame, path: str, tokenizer_name: str = "word_bpe_49k.json", end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text", lanes: int = LANES, block_ids: int = BLOCK_IDS,
                     check_rows: int = CHECK_ROWS) -> None:
    """Write ``path/blocks`` and ``path/table``.

    Texts are tokenized once; the ids are dealt by ranges of doc_id, sorted within each range and coded there.
    """
    spark = docs.sparkSession
    width = id_type_of(public_path(tokenizer_name), end_id)
    tokens = stored(tokenized(docs, public_path(tokenizer_name), end_id, id_col, text_col), "ids")
    table = frequency_table(tokens)
    scale = table.scale
    spark.createDataFrame([(int(i), int(f), scale) for i, f in zip(table.ids, table.freq)],
                          "id long, freq long, scale int").coalesce(1).write.parquet(f"{path}/table")
    ids, freq = table.ids, table.freq

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        own = Table(ids, freq, scale)
        position = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
        position[ids] = np.arange(len(ids), dtype=np.uint32)
        held, n_held, block, start, size = [], 0, 0, 0, np.dtype(width).itemsize

        def close() -> pa.RecordBatch:
            nonlocal held, n_held, block, start
            coded = np.frombuffer(b"".join(x for _, x in held), width)
            sizes = [len(x) // size for _, x in held]
            data = encode_block(position[coded], own, min(lanes, max(1, n_held)), check_rows)
            row = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                   pa.array([n_held], pa.int64()), pa.array([zlib.crc32(coded.astype("<u4").tobytes())], pa.int64()),
                   pa.array([[d for d, _ in held]], pa.list_(id_type)), pa.array([sizes], pa.list_(pa.int64())),
                   pa.array([data], pa.binary())]
            block, start, held, n_held = block + 1, start + n_held, [], 0
            return pa.RecordBatch.from_arrays(row, names)

        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            for doc, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((doc, x))
                n_held += len(x) // size
                if n_held >= block_ids:
                    yield close()
        if held:
            yield close()

    names = ["part", "block", "start_in_part", "n_tokens", "crc32", "doc_ids", "sizes", "data"]
    id_sql = tokens.schema["doc_id"].dataType.simpleString()
    schema = (f"part int, block int, start_in_part long, n_tokens long, crc32 long, doc_ids array<{id_sql}>, "
              "sizes array<bigint>, data binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tokens.filter("ids IS NOT NULL").select("doc_id", "ids").repartitionByRange(n, F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids").transform(arrow_map, run, schema)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/table").toPandas().sort_values("id")
    return Table(rows["id"].to_numpy(np.int64), rows["freq"].to_numpy(np.int64),
                 int(rows["scale"].iloc[0]) if len(rows) else SCALE)


def read_token_file(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, decoded block by block.

    A range's first position is the sum of the ranges before it: one number for each range goes to the driver.
    """
    table = read_table(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base = dict(zip((p for p, _ in totals), accumulate((n for _, n in totals), initial=0)))
    ids, freq, scale = table.ids, table.freq, table.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Table(ids, freq, scale)
        slots = own.symbols()
        for batch in batches:
            for k in range(batch.num_rows):
                part, start, crc, data = (batch.column(i)[k].as_py() for i in (0, 1, 2, 5))
                raw = memoryview(own.ids[decode_block(data, own, slots)].astype("<u4").tobytes())
                if zlib.crc32(raw) != crc:
                    raise ValueError("a block of token ids is damaged")
                sizes = np.asarray(batch.column(4)[k].as_py(), np.int64)
                ends = np.cumsum(sizes)
                cut = [raw[4 * (e - s):4 * e] for s, e in zip(sizes.tolist(), ends.tolist())]
                cols = [batch.column(3)[k].values, pa.array(base[part] + start + ends - sizes), pa.array(sizes),
                        pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(c) for c in cut], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    id_sql = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {id_sql}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return blocks.select("part", "start_in_part", "crc32", "doc_ids", "sizes", "data").transform(arrow_map, run, schema)


def token_file_round_trip(docs: DataFrame, tokenizer_name: str = "word_bpe_49k.json", **options) -> DataFrame:
    """Write the documents' token file into the shared folder and read it back."""
    path = scratch(docs.sparkSession, "tokens")
    write_token_file(docs, path, tokenizer_name, **options)
    return read_token_file(docs.sparkSession, path)
