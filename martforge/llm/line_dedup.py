"""Removing repeated multi-line passages by chunks with content-defined boundaries.

A text is its lines between line feeds. A line goes if it and a neighbouring line
stand together earlier: in a smaller document id, or further up in the same
document without sharing a line with that place. So a passage of two lines or more
goes whole at any offset, its first occurrence stays, and of a run of equal lines
two stay. Two comparisons find this:

1. Each line is hashed, and a rolling hash over the last ``WINDOW`` line hashes ends
   a chunk where it is divisible by ``AVERAGE``: boundaries depend on nearby lines
   alone, so a passage that is shifted by other lines is cut alike after its first
   lines. Chunks of at least ``LEAST`` lines that stand earlier, byte for byte, go.
2. Boundaries cut through short passages and the ends of long ones. Pairs of adjacent
   lines that lie in no chunk of step 1 are compared alike, and those that stand
   earlier go. The first occurrence of a pair never lies in a chunk that goes, so
   what step 1 leaves is all that step 2 has to see.

Lines are compared by their bytes once: all lines are grouped by (mark, content), the
mark being 8 bytes of their MD5, combined inside each task first. A mark that stands for
several contents (a collision) is replaced by the content itself, so equal marks are
equal lines. Chunks and pairs are compared by the marks of their lines, and texts move
only once more, to lose what goes. Occurrences of very frequent parts are spread over
many tasks.

Defined cases: a null text stays null and has no lines; an empty text has one
empty line; a last line feed makes an empty last line, and a carriage return
belongs to its line; rows that repeat id and text are the same occurrence, and of
one id, texts rank by SHA-256; rows without an id rank last. An empty table gives no
rows. Extra columns are carried by ``clean`` and never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import small_batches, spread_join, texts, whole_row, written

WINDOW = 3
AVERAGE = 4
LEAST = 2
#: The base of the rolling hash, modulo 2^32.
BASE = 31
#: Rows of one Arrow batch of occurrences.
ROWS = 1 << 14
_LAST = (1 << 63) - 1
#: A part of a text: its first line's number, its number of lines, their marks one after the other.
Part = tuple[int, int, bytes]


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.md5(line, usedforsecurity=False).digest()[:4], "big")


def chunk_sizes(lines: list[bytes], window: int = WINDOW, average: int = AVERAGE) -> list[int]:
    """Numbers of lines of a text's chunks, in order."""
    out, recent, ends = [0], [0] * window, False
    for line in lines:
        if ends:
            out.append(0)
        out[-1] += 1
        recent = [*recent[1:], line_hash(line)]
        rolling = 0
        for h in recent:
            rolling = (rolling * BASE + h) & 0xFFFFFFFF
        ends = rolling % average == 0
    return out


def chunk_parts(marks: list[bytes], sizes: list[int], _: list[dict]) -> Iterator[Part]:
    """The chunks of at least ``LEAST`` lines."""
    at = 0
    for n in sizes:
        if n >= LEAST:
            yield at, n, b"".join(marks[at:at + n])
        at += n


def pair_parts(marks: list[bytes], _: list[int], known: list[dict]) -> Iterator[Part]:
    """All pairs of adjacent lines that do not lie inside a ``known`` chunk."""
    inside = {i for c in known for i in range(c["at"], c["at"] + c["n"] - 1)}
    for i in range(len(marks) - 1):
        if i not in inside:
            yield i, 2, marks[i] + marks[i + 1]


def md5(content: bytes) -> bytes:
    return hashlib.md5(content, usedforsecurity=False).digest()[:8]


def collisions(rows: DataFrame, digest: Callable[[bytes], bytes] = md5) -> DataFrame:
    """(digest) of the lines' digests that stand for several contents."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            lines = list({line for text in texts(batch.column(0)) if text is not None for line in text.split(b"\n")})
            for at in range(0, len(lines), ROWS):
                some = lines[at:at + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(map(digest, some), pa.binary()), pa.array(some, pa.binary())],
                                                 names=["digest", "content"])

    return (rows.select("text").mapInArrow(spelled, "digest binary, content binary").distinct()
            .groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("digest"))


def marked_lines(rows: DataFrame, digest: Callable[[bytes], bytes] = md5) -> DataFrame:
    """(id, copy, marks, sizes) of each text: a mark for each line, equal for equal lines alone, and its chunks' numbers of lines."""
    collided = written(collisions(rows, digest), "collided")
    place = ["id", "copy"]
    if collided.isEmpty():
        rows = rows.withColumn("odd", F.lit(None).cast("array<binary>"))
    else:  # the digests that do not tell lines apart, for the texts that hold such lines

        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, 64):
                for ident, copy, text in zip(batch.column(0), batch.column(1), texts(batch.column(2))):
                    own = list({digest(line) for line in text.split(b"\n")} if text is not None else ())
                    yield pa.RecordBatch.from_arrays([pa.array([ident.as_py()] * len(own), pa.int64()),
                                                      pa.array([copy.as_py()] * len(own), pa.binary()), pa.array(own, pa.binary())],
                                                     names=["id", "copy", "digest"])

        held = rows.select(*place, "text").mapInArrow(digests, "id bigint, copy binary, digest binary").join(collided, "digest")
        rows = rows.join(held.groupBy(place).agg(F.collect_set("digest").alias("odd")), place, "left")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 512):
            marks, sizes = [], []
            for text, odd in zip(texts(batch.column(2)), batch.column(3).to_pylist()):
                lines = text.split(b"\n") if text is not None else []
                own = [(digest(line), line) for line in lines]
                # Each mark tells its own length, so marks in a row can be read in one way only.
                marks.append([bytes([len(d)]) + d if d not in (odd or ()) else b"\xff" + len(line).to_bytes(8, "big") + line
                              for d, line in own])
                sizes.append(chunk_sizes(lines) if lines else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.list_(pa.binary())),
                                              pa.array(sizes, pa.list_(pa.int64()))], names=["id", "copy", "marks", "sizes"])

    return rows.select(*place, "text", "odd").mapInArrow(mark, "id bigint, copy binary, marks array<binary>, sizes array<bigint>")


def occurrences(lines: DataFrame, parts: Callable[[list[bytes], list[int], list[dict]], Iterator[Part]]) -> DataFrame:
    """(id, copy, at, n, marks) of every part of each text."""
    names = ["id", "copy", "at", "n", "marks"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found)) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 512):
            out = []
            for ident, copy, marks, sizes, known in zip(*(c.to_pylist() for c in batch.columns)):
                for part in parts(marks, sizes, known or []):
                    out.append((ident, copy, *part))
                    if len(out) == ROWS:
                        yield as_batch(out)
                        out = []
            yield as_batch(out)

    return (lines.select("id", "copy", "marks", "sizes", "known")
            .mapInArrow(cut, "id bigint, copy binary, at bigint, n bigint, marks binary"))


def key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST))


def copy_of(text: Column) -> Column:
    """Tells the texts of one id apart: 16 bytes of their SHA-256."""
    return F.coalesce(F.unhex(F.left(F.sha2(text, 256), F.lit(32))), F.lit(b""))


def repeats(lines: DataFrame, parts: Callable[[list[bytes], list[int], list[dict]], Iterator[Part]], apart: int) -> DataFrame:
    """(id, copy, at, n) of the parts that stand earlier, at least ``apart`` lines earlier where in the same text."""
    found = occurrences(lines, parts)
    repeated = written(found.groupBy("marks").agg(F.min(F.struct("id", "copy", "at")).alias("first"), F.count(F.lit(1)).alias("times"))
                       .filter("times > 1"), "repeated")
    first = ((F.col("id") == F.col("first.id")) & (F.col("copy") == F.col("first.copy"))
             & (F.col("at") < F.col("first.at") + apart))
    return spread_join(found, repeated, "marks", "times").filter(~first).select("id", "copy", "at", "n")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None,
          digest: Callable[[bytes], bytes] = md5) -> DataFrame:
    """(row, text, n_lines, removed_lines): ``keep`` (default: the whole input row) and the text without repeated passages."""
    whole = keep if keep is not None else whole_row(docs)
    text = F.col(text_col).cast("string")
    rows = docs.select(whole.alias("row"), key(id_col).alias("id"), copy_of(text).alias("copy"), text.alias("text"))
    place = ["id", "copy"]
    lines = written(marked_lines(rows, digest), "lines")
    nothing = F.lit(None).cast("array<struct<at: bigint, n: bigint>>")
    known = written(repeats(lines.withColumn("known", nothing), chunk_parts, 1)
                    .groupBy(place).agg(F.collect_set(F.struct("at", "n")).alias("known")), "known")
    # Rows that repeat id and text are the same occurrence: their places are equal, so one of them stands for all.
    left = written(lines.dropDuplicates(place).join(known.hint("merge"), place, "left"), "left")
    pairs = repeats(left, pair_parts, 2).groupBy(place).agg(F.collect_set("at").alias("pairs"))
    gone = written(left.select(*place, "known").join(pairs, place, "left").filter("known IS NOT NULL OR pairs IS NOT NULL"), "gone")
    # What goes grows with the corpus, so it is never broadcast.
    marked = rows.join(gone.hint("merge"), place, "left").select("row", "text", "known", "pairs")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 512):
            out, n_lines, gone = [], [], []
            for text, known, pairs in zip(texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines = text.split(b"\n") if text is not None else []
                drop = {i for c in known or () for i in range(c["at"], c["at"] + c["n"])}
                drop.update(i + k for i in pairs or () for k in (0, 1))
                n_lines.append(len(lines))
                gone.append(len(drop))
                out.append(None if text is None else b"\n".join(line for i, line in enumerate(lines) if i not in drop))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(gone, pa.int64())],
                names=["row", "text", "n_lines", "removed_lines"])

    return marked.mapInArrow(rebuild, marked.select("row", "text").schema.add("n_lines", "long").add("removed_lines", "long"))
