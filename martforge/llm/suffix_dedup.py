"""Removing byte passages that occur again, by column-wise construction over aligned segments.

A byte goes if it lies in a string of ``WIDTH`` bytes that starts anywhere else too. A window
is such a string. Steps:

1. Anchors: each window names the ``GRAM``-gram in it with the smallest hash (the first on ties).
   Equal windows name the same gram at the same distance, so a window can only
   repeat where its gram does. The windows of one anchor form one segment, at most
   2 * WIDTH - GRAM bytes; each window of a text lies in exactly one segment.
2. Grams that occur once in the corpus go; segments of the others are cut out, and equal segments
   become one class with its count, combined in the tasks first.
3. Column-wise construction: the classes of a bucket of grams are aligned at
   their anchor and one symbol of each is inserted per round, from the last column to the first.
   A round reads the symbols before the suffixes in their order (that column of the
   Burrows-Wheeler transform), sorts stably by them, and updates the common prefix of
   neighbours: 1 + the least common prefix between their old places. Where it reaches
   WIDTH, both windows repeat; so do all windows of a class that stands for several segments.
4. Marked windows go back to the occurrences of their class, and their bytes from the texts.

The transform is kept by column: equal windows stand in the same column, so suffixes of
different columns are never compared. That makes a round linear in the segments; one transform over
all suffixes would rescan all earlier columns in every round. Arrays of a bucket are passed
from round to round in memory, as a bucket is bounded; tables between the steps are written.

Buckets hold about ``BUCKET`` classes. A gram with more than ``HOT`` classes is split by halving the range
of its windows: the windows of a half share more bytes around the anchor, and those
bytes join the key (``split``); at the last level a key holds equal windows only. So no group is
ever too large for a task, and nothing is cut short.

Defined cases: null text counts as empty; texts shorter than ``WIDTH`` lose nothing;
matches never cross rows; rows that repeat are occurrences of their own, so all their
windows repeat; rows with one id or without id are told apart by their text. An empty table gives no rows. Extra columns are
carried by ``clean`` and never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import dropped, release, small_batches, texts, whole_row, written

WIDTH = 200
#: Bytes of an anchor.
GRAM = 64
#: Classes per bucket, and classes of one gram from which it is split.
BUCKET = 8192
HOT = 16384
#: Rows of one Arrow batch of segments.
ROWS = 1 << 13
#: A symbol no text has, where a segment has no byte in a column.
NONE = 256
_BYTES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of all grams of a text, by doubling; ``gram`` is a power of two."""
    h, length = _BYTES[data], 1
    while length < gram:
        h = h[:-length] * np.uint64(0x9E3779B97F4A7C15 + 2 * length) + h[length:]
        length *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of the anchors of a text in order."""
    if data.size < width:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64))
    h = gram_hashes(data, gram)
    # Smallest of the upper hash halves in each window, the first one on ties, by doubling.
    least, length, span = (h & _HIGH) | np.arange(h.size, dtype=np.uint64), 1, width - gram + 1
    while 2 * length <= span:
        least = np.minimum(least[:-length], least[length:])
        length *= 2
    if span > length:
        least = np.minimum(least[:length - span], least[span - length:])
    at = (least & _LOW).astype(np.int64)
    cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
    first, last = np.concatenate(([0], cuts)), np.concatenate((cuts, [at.size])) - 1
    return h[at[first]], at[first], first, last


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``more`` columns and (id, tag, text): ``tag`` tells the texts of one id apart, and those of rows without id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(*more, F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def anchored(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """(id, tag, gram, at, row): hashes and places of each text's anchors; a place packs position, and distances to the first and last window.

    ``row`` numbers the rows as they are written, so that places are moved with one short number.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in small_batches(batches, 256):
            grams, places = [], []
            for text in texts(batch.column(2)):
                h, at, first, last = anchors(np.frombuffer(text, dtype=np.uint8), width, gram)
                grams.append(h.view(np.int64))
                places.append(at << 16 | (at - first) << 8 | (at - last))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(grams, pa.list_(pa.int64())),
                                              pa.array(places, pa.list_(pa.int64()))], names=["id", "tag", "gram", "at"])

    found = rows.filter(F.octet_length("text") >= width).mapInArrow(find, "id bigint, tag bigint, gram array<bigint>, at array<bigint>")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "anchors")


def segments(rows: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """(row, at, gram, digest, back, ahead, content) of the segments whose gram occurs more than once.

    ``back`` and ``ahead`` are the distances of the first and last window to the anchor; the segment starts at the first.
    """
    each = found.select("row", F.explode(F.arrays_zip("gram", "at")).alias("x")).select("row", "x.gram", "x.at")
    repeated = written(each.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "repeated")
    marks = each.join(repeated, "gram", "left_semi").groupBy("row").agg(F.collect_list(F.struct("at", "gram")).alias("marks"))
    # Rows that repeat id and text have the same places, and each meets those of all of them: one is enough.
    named = found.select("row", "id", "tag").join(marks, "row").groupBy("id", "tag").agg(F.min(F.struct("row", "marks")).alias("m"))
    named = named.select("id", "tag", "m.row", "m.marks")
    names = ["row", "at", "gram", "digest", "back", "ahead", "content"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            out = []
            for row, text, own in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2)):
                at, gram = (own.values.field(k).to_numpy() for k in ("at", "gram"))
                for place, h in sorted(zip(at.tolist(), gram.tolist())):
                    p, back, ahead = place >> 16, place >> 8 & 255, place & 255
                    content = text[p - back:p - ahead + width]
                    out.append((row, place, h, hashlib.blake2b(content, digest_size=16, salt=bytes((back, ahead))).digest(), back, ahead, content))
                    if len(out) == ROWS:
                        yield as_batch(out)
                        out = []
            yield as_batch(out)

    schema = "row bigint, at bigint, gram bigint, digest binary, back int, ahead int, content binary"
    cut_out = written(rows.join(named, ["id", "tag"]).select("row", "text", "marks").mapInArrow(cut, schema), "segments")
    dropped(repeated)
    return cut_out


def columns_of(content: list[bytes], back: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The segments' symbols by column, aligned at their anchors."""
    out = np.full((len(content), 2 * width - gram), NONE, dtype=np.uint16)
    for i, (text, start) in enumerate(zip(content, (width - gram - back).tolist())):
        out[i, start:start + len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.ascontiguousarray(out.T)


def common_prefixes(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(column, order, common): from the last column to the first, the order of the suffixes and each one's common prefix with the one before."""
    n = symbols.shape[1]
    order, common = np.arange(n), np.zeros(n, dtype=np.int32)
    for t in range(len(symbols) - 1, -1, -1):
        transform = symbols[t][order]
        place = np.argsort(transform, kind="stable")
        sorted_ = transform[place]
        same = np.flatnonzero(sorted_[1:] == sorted_[:-1])
        a, b = place[same], place[same + 1]
        least = common[b]
        far = np.flatnonzero(b - a > 1)
        if far.size:  # least common prefix over the places between; a 0 among them settles it
            zeros = np.cumsum(common == 0)
            over = zeros[b[far]] != zeros[a[far]]
            least[far[over]] = 0
            far = far[~over]
        if far.size:
            ends = np.empty(2 * far.size, dtype=np.int64)
            ends[0::2], ends[1::2] = a[far] + 1, b[far] + 1
            least[far] = np.minimum.reduceat(np.append(common, 0), ends)[0::2]
        common = np.zeros(n, dtype=np.int32)
        common[same + 1] = least + 1
        order = order[place]
        yield t, order, common


def marked_windows(content: list[bytes], back: np.ndarray, ahead: np.ndarray, copies: np.ndarray, width: int, gram: int) -> np.ndarray:
    """One row per segment, one column per distance: whether its window at that column repeats."""
    span = width - gram + 1
    out = np.zeros((span, len(content)), dtype=bool)
    for t, order, common in common_prefixes(columns_of(content, back, width, gram)):
        if t < span:
            equal = np.flatnonzero(common >= width)
            out[t, order[equal]] = out[t, order[equal - 1]] = True
    column = np.arange(span)[:, None]
    # Segments begin and end in different columns; outside, what they share is the absence of symbols.
    return (out | (copies > 1)) .T & ((column >= span - 1 - back) & (column <= span - 1 - ahead)).T


def runs(marked: np.ndarray) -> list[dict]:
    """Maximal runs of True as inclusive {a, b}."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return [{"a": a, "b": b - 1} for a, b in edges.reshape(-1, 2).tolist()]


def compared(classes: DataFrame, parts: int, width: int, gram: int) -> DataFrame:
    """(digest, runs): repeated windows of each class, as runs counted from its segment's first window."""
    schema = pa.schema([("digest", pa.binary()), ("runs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])

    def in_bucket(group: pa.Table) -> pa.Table:
        key = group["gram"].to_numpy()
        back, ahead, copies = (group[c].to_numpy() for c in ("back", "ahead", "n"))
        _, at, sizes = np.unique(key, return_inverse=True, return_counts=True)
        several = np.flatnonzero(sizes[at] > 1)
        marked = np.zeros((len(key), width - gram + 1), dtype=bool)
        alone = np.flatnonzero(sizes[at] == 1)
        if several.size:
            content = group["content"].take(pa.array(several)).to_pylist()
            marked[several] = marked_windows(content, back[several], ahead[several], copies[several], width, gram)
        column = np.arange(width - gram + 1)[None, :]
        marked[alone] = ((copies[alone] > 1)[:, None] & (column >= (width - gram - back[alone])[:, None])
                         & (column <= (width - gram - ahead[alone])[:, None]))
        keep = np.flatnonzero(marked.any(axis=1))
        out = [runs(marked[i, width - gram - back[i]:]) for i in keep.tolist()]
        return pa.Table.from_arrays([group["digest"].take(pa.array(keep)).combine_chunks().cast(pa.binary()), pa.array(out, schema.field("runs").type)], schema=schema)

    bucket = F.pmod(F.xxhash64("gram"), F.lit(parts)).alias("bucket")
    return (classes.select(bucket, "gram", "digest", "back", "ahead", "n", "content").groupBy("bucket")
            .applyInArrow(in_bucket, "digest binary, runs array<struct<a:int,b:int>>"))


def split(classes: DataFrame, width: int) -> DataFrame:
    """The classes of too frequent keys by halves of their window range, with the class each part comes from.

    (origin, shift, gram, lo, hi, digest, back, ahead, n, content): all windows of a half share the bytes from the
    half's last start to its first end, and those bytes are part of the new key.
    """
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = classes.withColumn("half", F.explode(F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
                                                          F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi")))))
    cut = (halves.withColumn("new_back", F.least("back", "half.hi")).withColumn("new_ahead", F.greatest("ahead", "half.lo"))
           .filter("new_back >= new_ahead"))
    start = F.col("back") - F.col("new_back")
    content = F.expr(f"substring(content, back - new_back + 1, new_back - new_ahead + {width})")
    shared = F.expr(f"substring(content, back - half.lo + 1, half.lo - half.hi + {width})")
    parts = cut.select(F.col("digest").alias("origin"), start.alias("shift"), F.xxhash64("gram", "half.lo", shared).alias("gram"),
                       F.col("half.lo").alias("lo"), F.col("half.hi").alias("hi"), F.col("new_back").alias("back"),
                       F.col("new_ahead").alias("ahead"), "n", content.alias("content"))
    return parts.withColumn("digest", F.unhex(F.sha2(F.concat(F.encode(F.concat_ws(",", "gram", "back", "ahead", "lo", "hi"), "UTF-8"), "content"), 256)))


def repeated_windows(classes: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """(digest, runs) of all classes (gram, lo, hi, digest, back, ahead, n, content); ``lo`` and ``hi`` bound the key's window range."""
    sizes = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("classes"))
    frequent = written(sizes.filter((F.col("classes") > hot)).select("gram"), "frequent")
    parts = max(1, -(-classes.count() // bucket))
    if frequent.isEmpty():
        return compared(classes, parts, width, gram)
    few = compared(classes.join(frequent, "gram", "left_anti"), parts, width, gram)
    many = written(classes.join(frequent, "gram", "left_semi"), "many")
    # A range of one window: its classes are different windows, so only copies repeat.
    whole = many.filter("lo = hi AND n > 1").select("digest", F.expr("array(named_struct('a', 0, 'b', 0))").alias("runs"))
    pieces = written(split(many.filter("lo < hi"), width), "pieces")
    if pieces.isEmpty():
        return few.unionByName(whole)
    own = written(pieces.groupBy("gram", "lo", "hi", "digest", "back", "ahead", "content").agg(F.sum("n").alias("n")), "classes")
    found = repeated_windows(own, width, gram, bucket, hot)
    back = (pieces.select("origin", "shift", "digest").join(found, "digest")
            .select(F.col("origin").alias("digest"), F.expr("transform(runs, r -> named_struct('a', r.a + shift, 'b', r.b + shift))").alias("runs"))
            .groupBy("digest").agg(F.flatten(F.collect_list("runs")).alias("runs")))
    return few.unionByName(whole).unionByName(back)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
             bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """(id, tag, spans): of every text with repeated windows, where runs of them start and where the last one's bytes end."""
    rows = keyed(docs, id_col, text_col)
    anchors_of = anchored(rows, width, gram)
    cut = segments(rows, anchors_of, width)
    names = written(anchors_of.select("row", "id", "tag"), "rows")
    dropped(anchors_of)
    classes = written(cut.groupBy("gram", "digest", "back", "ahead", "content").agg(F.count(F.lit(1)).alias("n"))
                      .withColumn("lo", F.lit(0)).withColumn("hi", F.lit(width - gram)), "classes")
    found = written(repeated_windows(classes, width, gram, bucket, hot), "found")
    dropped(classes)
    start = F.expr("shiftright(at, 16) - (shiftright(at, 8) & 255)")
    spans = F.expr(f"transform(runs, r -> named_struct('start', start + r.a, 'end', start + r.b + {width}))")
    by_row = (cut.select("row", "digest", start.alias("start")).join(found, "digest")
              .select("row", F.explode(spans).alias("span")).groupBy("row").agg(F.sort_array(F.collect_set("span")).alias("spans")))
    # Rows that repeat id and text come from one of them: their lists are the same.
    done = written(by_row.join(names, "row").select("id", "tag", "spans").dropDuplicates(["id", "tag"]), "spans")
    dropped(cut, found, names)
    return done


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
          bucket: int = BUCKET, hot: int = HOT, keep: Column | None = None) -> DataFrame:
    """(row, kept, n_bytes, n_removed, spans): ``keep`` (default: the whole input row), the remaining bytes, and the removed runs."""
    if gram & (gram - 1) or not gram <= width <= gram + 255:
        raise ValueError("gram must be a power of two, at most width and at least width - 255")
    whole = keep if keep is not None else whole_row(docs)
    rows = keyed(docs, id_col, text_col, whole.alias("row"))
    marked = rows.join(removals(docs, id_col, text_col, width, gram, bucket, hot), ["id", "tag"], "left").select("row", "text", "spans")
    run = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            kept, sizes, removed = [], [], []
            for text, spans in zip(texts(batch.column(1)), batch.column(2).to_pylist()):
                merged: list[dict] = []
                for s in spans or ():
                    if merged and s["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                    else:
                        merged.append(dict(s))
                edges = [0, *(x for s in merged for x in (s["start"], s["end"])), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(text))
                removed.append(merged)
            gone = [n - len(k) for n, k in zip(sizes, kept)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(removed, pa.list_(run))], names=["row", "kept", "n_bytes", "n_removed", "spans"])

    span_type = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
    schema = marked.select("row").schema.add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("spans", span_type)
    return marked.mapInArrow(rebuild, schema)

