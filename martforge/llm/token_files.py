"""Token-id files compressed by a Re-Pair grammar per shard, with random access.

A shard holds the ids of consecutive documents in ascending id order. Rounds
of pair replacement turn it into a short sequence of symbols and a list of
rules: each round counts all adjacent pairs, makes a rule of every pair that is
frequent enough for the round (the bar falls from round to round) and replaces
its occurrences from left to right, until no pair is left that occurs
``LEAST_COUNT`` times. The file keeps the symbols, the rules (two
symbols each) and every rule's expansion length; prefix sums of expansion
lengths find the symbols that cover any range of ids, so a range is decoded
without its shard's other symbols.

A file set is a folder of Parquet files, one row per shard: Spark's committed
writes make it safe against lost executors, and any store Spark can write will
do. Columns: part and nth (order of shards), n_tokens, first_symbol (symbols
below it are ids, the others rules), symbols, rules, expansions (little-endian
unsigned 32-bit), doc_ids and doc_lengths (little-endian signed 64-bit),
no_ids (positions of null document ids).

Defined cases: null and empty texts are their end id alone; null ids come
first; rows of equal id follow in the order of their texts; repeated rows are
separate documents; an empty table writes no shard. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import small_batches, written
from martforge.llm.encoding import encoder

END_ID = 2
#: A shard is closed after the document with which it reaches so many ids.
SHARD_TOKENS = 1 << 19
#: The least number of occurrences that makes a rule.
LEAST_COUNT = 8
#: Slots in which pairs are counted first, in bits.
SLOTS = 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
SHARD = ("part int, nth bigint, n_tokens bigint, first_symbol bigint, symbols binary, rules binary, expansions binary, "
         "doc_ids binary, doc_lengths binary, no_ids binary")


def compress(ids: np.ndarray, rounds: int | None = None, least: int = LEAST_COUNT) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(first_symbol, symbols, rules, expansions): rule i is the pair that symbol first_symbol + i stands for.

    ``rounds`` stops the replacement early; without it no pair is left that occurs ``least`` times.
    """
    seq = ids.astype("<u4")
    first = int(seq.max()) + 1 if seq.size else 0
    rules: list[np.ndarray] = []
    size = np.ones(first, dtype=np.uint32)
    turn = 0
    while seq.size > 1 and turn != rounds:
        # A pair as one number: 32 bits while all symbols fit 16.
        wide = np.uint64 if size.size > 1 << 16 else np.uint32
        half = wide(wide(0).nbytes * 4)
        pairs = seq[:-1].astype(wide) << half | seq[1:].astype(wide)
        hashes = pairs.astype(np.uint64) * _ODD
        maybe = np.arange(pairs.size)
        if turn > 1:  # few are frequent now: a slot of fewer than ``least`` pairs holds no frequent one
            slots = (hashes >> np.uint64(64 - SLOTS)).astype(np.int64)
            maybe = np.flatnonzero((np.bincount(slots, minlength=1 << SLOTS) >= least)[slots])
            if not maybe.size:
                break
        ordered = np.sort(pairs[maybe])
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(starts, ordered.size))
        bar = max(least, int(counts.max()) >> (3 * turn + 5)) if turn + 1 != rounds else least
        frequent = ordered[starts[counts >= bar]]
        if not frequent.size:
            break
        turn += 1
        # Pairs are looked up by hash; of pairs that fall into one slot the last is replaced in this round.
        bits = np.uint64(64 - max(12, int(frequent.size * 16).bit_length()))
        table = np.zeros(1 << (64 - int(bits)), dtype=np.int32)
        table[(frequent.astype(np.uint64) * _ODD) >> bits] = np.arange(frequent.size)
        place = np.zeros(pairs.size, dtype=np.int32)
        place[maybe] = table[hashes[maybe] >> bits]
        at = maybe[frequent[place[maybe]] == pairs[maybe]]
        # Overlapping occurrences, at neighbouring places: from left to right, every second one.
        run = np.concatenate(([True], np.diff(at) != 1))
        begin = np.maximum.accumulate(np.where(run, np.arange(at.size), 0))
        at = at[(np.arange(at.size) - begin) % 2 == 0]
        used = np.zeros(frequent.size, dtype=bool)
        used[place[at]] = True
        chosen, number = frequent[used], np.cumsum(used) - 1
        left, right = chosen >> half, chosen & wide((1 << int(half)) - 1)
        rules.append(np.stack([left, right], axis=1).astype("<u4"))
        base = size.size
        size = np.concatenate([size, size[left] + size[right]])
        seq[at] = (base + number[place[at]]).astype("<u4")
        keep = np.ones(seq.size, dtype=bool)
        keep[at + 1] = False
        seq = seq[keep]
    flat = np.concatenate(rules) if rules else np.zeros((0, 2), dtype="<u4")
    return first, seq, flat, size[first:].astype("<u4")


def expansion_table(first: int, rules: np.ndarray, expansions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, starts, lengths): the ids that each symbol stands for, one after another."""
    lengths = np.concatenate([np.ones(first, dtype=np.int64), expansions.astype(np.int64)])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if lengths.size else np.zeros(0, dtype=np.int64)
    ids = np.zeros(int(lengths.sum()), dtype="<u4")
    ids[:first] = np.arange(first)
    newest = rules.max(axis=1, initial=0).astype(np.int64) - first
    done = 0
    while done < len(rules):  # a rule's symbols are older than the rule: all rules at once that need none of each other
        waits = np.flatnonzero(newest[done:] >= done)
        upto = done + int(waits[0]) if waits.size else len(rules)
        made = expand(rules[done:upto].reshape(-1).astype(np.int64), (ids, starts, lengths))
        ids[starts[first + done]:starts[first + done] + made.size] = made
        done = upto
    return ids, starts, lengths


def expand(symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    ids, starts, lengths = table
    n = lengths[symbols]
    ends = np.cumsum(n)
    shift = np.repeat(starts[symbols] - (ends - n), n)
    return ids[shift + np.arange(shift.size)]


def decode_range(shard, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a shard row: only the symbols that cover them are expanded."""
    rules = np.frombuffer(shard["rules"], dtype="<u4").reshape(-1, 2)
    expansions = np.frombuffer(shard["expansions"], dtype="<u4")
    symbols = np.frombuffer(shard["symbols"], dtype="<u4").astype(np.int64)
    first = shard["first_symbol"]
    ends = np.cumsum(np.concatenate([np.ones(first, dtype=np.int64), expansions])[symbols])
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
    out: list[int] = []
    for symbol in symbols[a:b + 1].tolist():
        stack = [symbol]
        while stack:
            x = stack.pop()
            if x < first:
                out.append(x)
            else:
                stack += [int(rules[x - first][1]), int(rules[x - first][0])]
    skip = start - (int(ends[a - 1]) if a else 0)
    return np.array(out[skip:skip + stop - start], dtype="<u4")


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, rounds: int | None = None, least: int = LEAST_COUNT) -> None:
    """Encode all documents and write their ids in ascending id order as compressed shards under ``path``."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def shard(part: int, nth: int, ids: list[bytes], doc_ids: list[int | None]) -> tuple:
        whole = np.frombuffer(b"".join(ids), dtype="<u4")
        first, symbols, rules, expansions = compress(whole, rounds, least)
        null = [i for i, x in enumerate(doc_ids) if x is None]
        return (part, nth, whole.size, first, symbols.tobytes(), rules.tobytes(), expansions.tobytes(),
                np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
                np.array([len(x) // 4 for x in ids], dtype="<i8").tobytes(), np.array(null, dtype="<i8").tobytes())

    def as_batch(row: tuple) -> pa.RecordBatch:
        types = [pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)],
                                          names=[c.split()[0] for c in SHARD.split(", ")])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = encoder(tokenizer), TaskContext.get().partitionId()
        nth, size, ids, doc_ids = 0, 0, [], []
        for batch in small_batches(batches, 256):
            for doc_id, own in zip(batch.column(0).to_pylist(), ids_of(batch.column(1).to_pylist())):
                ids.append(own + end)
                doc_ids.append(doc_id)
                size += len(own) // 4 + 1
                if size >= shard_tokens:
                    yield as_batch(shard(part, nth, ids, doc_ids))
                    nth, size, ids, doc_ids = nth + 1, 0, [], []
        if ids:
            yield as_batch(shard(part, nth, ids, doc_ids))

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    (rows.repartitionByRange("id").sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
     .mapInArrow(encode, SHARD).write.parquet(path))


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a file set with ``first``, the number of ids in all shards before each."""
    found = spark.read.schema(SHARD).parquet(path)
    sizes = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per written part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_first"))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that Spark sees how small it is and leaves the shards where they are.
    firsts = written(found.select("part", "nth", "n_tokens")
                     .withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
                     .join(starts, "part").select("part", "nth", (F.col("part_first") + F.col("inside")).alias("first")), "firsts")
    return found.join(firsts, ["part", "nth"])


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files, and its ``ids`` if asked for."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if ids else [])])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            row = batch.to_pylist()[0]
            table = expansion_table(row["first_symbol"], np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2),
                                    np.frombuffer(row["expansions"], dtype="<u4"))
            data = expand(np.frombuffer(row["symbols"], dtype="<u4").astype(np.int64), table).tobytes()
            lengths = np.frombuffer(row["doc_lengths"], dtype="<i8")
            ends = np.cumsum(lengths)
            begins = ends - lengths
            own = [data[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
            doc_ids = np.frombuffer(row["doc_ids"], dtype="<i8")
            null = np.zeros(doc_ids.size, dtype=bool)
            null[np.frombuffer(row["no_ids"], dtype="<i8")] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, mask=null), pa.array(begins + row["first"]), pa.array(lengths),
                 pa.array([zlib.crc32(x) for x in own], pa.int64()), *([pa.array(own, pa.binary())] if ids else [])],
                schema=schema)

    return shards(spark, path).mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids)
