"""Best-fit packing planned on the histogram of piece lengths.

1. Whole texts are tokenized and documents longer than a sequence are cut
   (the first piece takes the remainder, the others are full).
2. Only the counts of pieces by length (at most ``capacity`` numbers) go to
   the driver, where best-fit decreasing runs over counts: a bin pattern is
   placed once with a multiplicity, so the work depends on the number of
   lengths, not of documents.
3. The plan is a small table of runs: pieces of one length with ranks
   a..b take the sequences s, s+1, ... at one offset.  Each piece gets its
   rank within its length from partition counts (no global sort, no window
   over a length) and takes its slot by binary search in the plan.

Defined results: a null text is an empty one (only the end id).  Repeated
rows are packed as often as they occur.  An empty table gives no piece.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import arrow_map, stored
from .tokens import public_path, tokenizer

CAPACITY = 1024
END_ID = 2


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32, and their place
    among the pieces of this length in this task (part, rank)."""
    schema = [T.StructField("doc_id", docs.schema[id_col].dataType)]
    schema += [T.StructField(n, t) for n, t in (("piece", T.IntegerType()), ("start", T.LongType()),
                                                ("length", T.LongType()), ("ids_crc32", T.LongType()),
                                                ("part", T.IntegerType()), ("rank", T.LongType()))]
    if with_ids:
        schema.append(T.StructField("ids", T.BinaryType()))
    names = [f.name for f in schema]
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encode = tokenizer(tokenizer_path).encode
        seen = [0] * (capacity + 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sub = batch.slice(at, 512)
                rows: list[tuple] = []
                take = []
                for k, text in enumerate(sub.column(1).to_pylist()):
                    ids = memoryview(encode(text) + end)
                    for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start:4 * (start + length)]
                        row = (piece, start, length, zlib.crc32(own), part, seen[length])
                        rows.append((*row, bytes(own)) if with_ids else row)
                        seen[length] += 1
                        take.append(k)
                cols = list(zip(*rows))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [sub.column(0).take(pa.array(take, pa.int32()))] + [pa.array(c, t) for c, t in zip(cols, types)],
                    names)

    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")) \
        .transform(arrow_map, run, T.StructType(schema))


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns runs (length, first rank, number, first sequence, offset): pieces of this length
    with ranks first..first+number-1 take the sequences from the first on, at this offset.

    Open bins are kept as groups of equal room; lengths are taken from long to short, and
    pieces go to the fullest group that they fit into, bin after bin, as many into each as fit.
    """
    left = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence, number of bins)]
    rooms: list[int] = []  # sorted keys of groups
    runs, free = [], 0

    def put(room: int, first: int, number: int) -> None:
        if room not in groups:
            groups[room] = []
            bisect.insort(rooms, room)
        groups[room].append((first, number))

    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            k = bisect.bisect_left(rooms, length)
            if k == len(rooms):  # new bins, each with as many of this length as fit
                per = max(1, capacity // length)
                bins, rest = divmod(need, per)
                for each, number in ((per, bins), (rest, 1 if rest else 0)):
                    if number:
                        for j in range(each):
                            runs.append((length, rank[length], number, free, j * length))
                            rank[length] += number
                        put(capacity - each * length, free, number)
                        free += number
                need = 0
                continue
            room = rooms[k]
            first, number = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(k)
            # a bin that has taken a piece is the fullest one that fits the next, until it fits no more
            per = room // length
            bins, rest = divmod(need, per)
            used = 0
            for each, some in ((per, min(bins, number)), (rest, 1 if rest and bins < number else 0)):
                for j in range(each if some else 0):
                    runs.append((length, rank[length], some, first + used, capacity - room + j * length))
                    rank[length] += some
                if each and some:
                    need -= each * some
                    put(room - each * length, first + used, some)
                    used += some
            if used < number:
                put(room, first + used, number - used)
    return runs


def place(pieces: DataFrame, runs: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Adds sequence_id and offset to pieces with their global ``rank`` within ``length``."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    shift = int(table[:, 1].max() + table[:, 2].max() + 1) if len(table) else 1
    keys = table[:, 0] * shift + table[:, 1]
    fields = [f for f in pieces.schema.fields if f.name != "rank"]
    schema = T.StructType(fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            sequence = table[at, 3] + rank - table[at, 1]
            kept = [b.column(b.schema.get_field_index(f.name)) for f in fields]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(sequence), pa.array(table[at, 4])], names)

    return pieces.transform(arrow_map, run, schema)


def pack_best_fit(docs: DataFrame, tokenizer_name: str = "byte_bpe_50k.json", capacity: int = CAPACITY,
                  end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (with ``with_ids`` also ``ids``, the piece's little-endian unsigned 32-bit ids).

    Runs two jobs: the pieces are written once to the shared folder (without ids unless
    asked for), and their counts by length are gathered (at most ``capacity`` rows).
    """
    pieces = stored(tokenized_pieces(docs, public_path(tokenizer_name), capacity, end_id, id_col, text_col, with_ids),
                    "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(bases, ["part", "length"])
              .withColumn("rank", F.col("rank") + F.col("base"))
              .select("doc_id", "piece", "start", "length", "ids_crc32", "rank", *(["ids"] if with_ids else [])))
    return place(ranked, plan_runs(counts, capacity))
