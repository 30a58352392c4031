"""Packing token sequences by shortest-pack-first over the length histogram.

Documents are encoded, closed with an end id and cut into pieces of at most
``max_len`` ids: whole pieces and one remainder. Only the histogram of piece
lengths (at most ``max_len`` rows, whatever the corpus) reaches the driver.
There, lengths are placed longest first, each into the pack with the most room;
equal packs are one pattern with a count, so the work depends on ``max_len``
and not on the number of documents. Slots of the patterns are numbered by
length, and the pieces of each length take them by rank: ranks are counted per
task while encoding, and a table of task and length counts makes them global.

Defined cases: a null or empty text is its end id alone; repeated rows and ids
are separate documents; a null id is carried; an empty table has no pieces.
Extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import offsets_by, release, small_batches, written
from martforge.llm.encoding import encoder

MAX_LEN = 1024
END_ID = 0
#: Pieces of texts kept per Python worker: fewer than MEMO, as its task also writes all ids through the JVM beside it.
MEMO = 300_000
PIECES = "part int, nth bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """Written pieces of all documents; ``nth`` counts the pieces of one length within one task (``part``)."""
    schema = pa.schema([("part", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                        ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer, MEMO), TaskContext.get().partitionId(), np.zeros(max_len + 1, dtype=np.int64)
        for batch in small_batches(batches, 256):
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, max_len):
                    length = min(max_len, n - start)
                    out.append((part, int(seen[length]), doc_id, start, length, n, ids[4 * start:4 * (start + length)]))
                    seen[length] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return written(rows.mapInArrow(cut, PIECES), "pieces")


def shortest_pack_first(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns [(count, lengths)]: every length of the histogram placed, longest first."""
    packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # by room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, ps in packs.items() if ps), default=0)
            if room >= length:  # the shortest pack
                count, pattern = packs[room].pop()
                used = min(left, count)
                if count > used:
                    packs[room].append((count - used, pattern))
                packs[room - length].append((used, (*pattern, length)))
            else:  # none has room: new packs, each filled while it is the shortest
                each = min(max_len // length, left)
                used = left // each * each
                packs[max_len - each * length].append((left // each, (length,) * each))
            left -= used
    return [p for ps in packs.values() for p in ps]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): runs of equal slots, in order of length and rank."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(cut: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Add sequence_id and offset to written pieces: one row per piece, without its ids."""
    counts = written(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    # At most max_len rows: one per length that occurs.
    found = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(shortest_pack_first(found, max_len))
    starts = offsets_by(counts, ["length"], "part", "n", "before").drop("n")
    key = table[:, 0] << 44 | table[:, 1]
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in kept], pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])],
                names=[*kept, "sequence_id", "offset"])

    rows = (cut.select("part", "nth", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
            .join(starts, ["part", "length"]).select(*kept, (F.col("before") + F.col("nth")).alias("rank")))
    out = rows.mapInArrow(place, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                 "part int, nth bigint, sequence_id bigint, offset bigint")
    return out.select(*kept[:5], "sequence_id", "offset", "part", "nth")


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, length): the packed sequences themselves; a sequence holds at most ``max_len`` ids."""
    key = ["part", "length", "nth"]
    return (cut.select(*key, "ids").join(placed.select(*key, "sequence_id", "offset"), key)
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("at"))
            .select("sequence_id", F.expr("aggregate(at, X'', (x, y) -> concat(x, y.ids))").alias("ids"))
            .withColumn("length", (F.octet_length("ids") / 4).cast("bigint")))


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    return pack(pieces(docs, tokenizer, id_col, text_col, max_len, end_id), max_len)
