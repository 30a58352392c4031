"""Near-duplicate detection by bottom-k MinHash sketches, verified on full shingle sets.

One hash function maps shingles to 64 bits; a document's sketch is the ``k``
smallest hashes of its set. Steps:

1. Documents with the same set are one class; classes stand for their copies.
2. Inverted lists of retained values generate candidates. Two sets of Jaccard
   similarity t share at least ``c`` of their k retained values but for a chance
   of ``MISS`` (a binomial tail), so it is enough that each class posts its rarest
   (shared values - c + 1): by the prefix argument, linked classes meet in a list.
   Values held by one class alone, and values common to all, cost nothing.
3. Star round: in each list every class meets only the list's smallest class.
   Pairs pass the union-sketch estimate (the share of the k smallest values of
   the union that both hold), then exact Jaccard on the full sets decides.
4. Rest round: classes that share a list but are still in different components
   are compared too. Short lists emit such pairs. For classes of long lists the
   shingles that no other such class holds are counted on the full sets first (``alone``): a pair
   cannot share more than either side has left, so a class whose rest is
   below p / (100 + p) of both sizes can link with none and goes (``able``). What stays is cut into
   blocks, and each pair of blocks is one bounded task that returns pairs as
   arrays. A pair that meets in several long lists belongs to the first of them.
   So a group of near copies costs its size, not its square, also where its members
   differ too much to be linked, and no list is ever cut short.
5. Components of the verified links give the groups.

Nothing is dropped or capped: a common value only moves its list to step 4's blocks.

Defined cases: null or word-less texts have an empty set and link with nothing;
texts shorter than a shingle are one shingle; rows that share an id are one
node; rows without an id link with nothing, have no component and are kept.
Repeated rows are returned as often as given; ``dedup`` keeps one. Extra
columns are carried by ``dedup`` and never read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import components, mix64, release, small_batches, texts, words, wrapped, written

SHINGLE = 4
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Retained values per sketch.
K = 64
#: Chance that a linked pair shares fewer retained values than relied on.
MISS = 1e-9
#: Lists up to this length emit pairs, each class at most this many; longer ones go to blocks.
SHORT = 48
#: Classes per block of a long list; a task holds two blocks.
BLOCK = 512
#: Pairs verified together in one task.
BUCKET = 512
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shared_at_least(k: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Retained values that two sets of the threshold's similarity share but for a chance of ``miss``."""
    p, total = percent / 100, 0.0
    for c in range(k + 1):
        total += comb(k, c) * p**c * (1 - p) ** (k - c)
        if total > miss:
            return max(1, c)
    return k


def shingle_set(text, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all word n-grams of a whole text."""
    tokens = words(text)
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    size = min(n, len(tokens))
    count = hashed.size - size + 1
    out = np.full(count, size, dtype=np.uint64)
    for j in range(size):
        out = mix64(out + hashed[j:j + count] * _STEPS[j % len(_STEPS)])
    return np.unique(out)


def sketched(docs: DataFrame, shingle: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, digest, sketch): set size, digest of the set and its k smallest hashes."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.list_(pa.int64()))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in small_batches(batches):
            sets = [shingle_set(t, shingle) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.size for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s[:k].astype(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return rows.mapInArrow(build, "doc_id bigint, n bigint, digest binary, sketch array<bigint>")


def prefixes(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(cid, n, prefix): the rarest shared values under which each class is posted."""
    values = classes.select("cid", "n", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Sets small enough to be their own sketch share exactly; the others but for MISS.
    need = (F.when(F.col("n") * 100 <= k * percent, F.ceil(F.col("n") * percent / 100))
            .otherwise(F.lit(shared_at_least(k, percent))).cast("int"))
    held = (values.join(shared, "value").groupBy("cid")
            .agg(F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("held")))
    rarest = F.slice("held.value", 1, F.greatest(F.size("held") - need + 1, F.lit(0)))
    return held.select("cid", "n", F.array_distinct(rarest).alias("prefix")).filter(F.size("prefix") > 0)


def estimate(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Union-sketch estimate of the Jaccard similarity from the k smallest values of two sorted sets."""
    both = np.sort(np.concatenate([a[:k], b[:k]]))
    again = both[1:] == both[:-1]
    head = both[np.concatenate(([True], ~again))][:k]
    return np.count_nonzero(both[1:][again] <= head[-1]) / head.size if head.size else 0.0


def verified(pairs: DataFrame, keys: list[str], sets: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) among rows (keys, lefts, rights, labels, mask).

    ``mask`` has one bit for each left and right class, row by row: 1 where they are to be compared. ``labels`` are the
    components of the rights; one link of a left class to each component is enough.
    """
    least = shared_at_least(k, percent) / k
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    pairs = written(pairs, "to_verify")
    own_keys = [f"own_{c}" for c in keys]
    members = (pairs.select(*[F.col(c).alias(o) for c, o in zip(keys, own_keys)],
                            F.explode(F.array_union("lefts", "rights")).alias("cid")).distinct()
               .join(sets, "cid").select(*own_keys, "cid", "hashes"))

    def alike(mine: np.ndarray, other: np.ndarray) -> bool:
        if 100 * min(mine.size, other.size) < percent * max(mine.size, other.size):
            return False
        if mine.size > k and other.size > k and estimate(mine, other, k) < least:
            return False
        both = np.sort(np.concatenate([mine, other]))
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * shared >= percent * (mine.size + other.size - shared)

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        own: dict[int, list[np.ndarray]] = defaultdict(list)
        for cid, data in zip(right["cid"].to_pylist(), right["hashes"].to_pylist()):
            own[cid].append(np.frombuffer(data, dtype=np.uint64))
        a, b = [], []
        for row in left.to_pylist():
            wanted = unpacked(row["mask"], len(row["lefts"]), len(row["rights"]))
            for x, at in zip(row["lefts"], wanted):
                done = set()
                for y in np.flatnonzero(at).tolist():
                    other, label = row["rights"][y], row["labels"][y]
                    if label not in done and any(alike(p, q) for p in own.get(x, ()) for q in own.get(other, ())):
                        a.append(x)
                        b.append(other)
                        done.add(label)
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return pairs.groupBy(*keys).cogroup(members.groupBy(*own_keys)).applyInArrow(check, "a bigint, b bigint")


def unpacked(mask: bytes, rows: int, columns: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=rows * columns).reshape(rows, columns).astype(bool)


def bucketed(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y, label) as rows for ``verified``, about BUCKET pairs a bucket, however many x has."""
    made = written(pairs, "pairs")
    n = max(1, -(-made.count() // BUCKET))
    per_x = made.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / BUCKET).alias("parts"))
    part = F.pmod(F.xxhash64("y"), F.col("parts"))
    return (made.join(per_x, "x").withColumn("part", part)
            .groupBy(F.pmod(F.xxhash64("x", "part"), F.lit(n)).alias("bucket"), "x", "part")
            .agg(F.collect_list(F.struct("y", "label")).alias("at"))
            .select("bucket", F.array("x").alias("lefts"), F.col("at.y").alias("rights"), F.col("at.label").alias("labels"),
                    # All bits set: one byte holds eight pairs.
                    F.unhex(F.repeat(F.lit("FF"), F.ceil(F.size("at") / 8).cast("int"))).alias("mask")))


def block_pairs(long: DataFrame, percent: int) -> DataFrame:
    """Rows for ``verified`` of the long lists' pairs of blocks: pairs in different components that belong to this list.

    Rows of ``long``: value, m (length of its list), cid, n, label, prefix (all values of the class's lists),
    common (shingles of its set that others of ``long`` hold too, at most).
    """
    count = F.ceil(F.col("m") / BLOCK).cast("int")
    placed = long.withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    spread = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "block", "cid", "n", "label", "prefix", "common"))
    schema = pa.schema([("value", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("lefts", pa.list_(pa.int64())),
                        ("rights", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("mask", pa.binary())])

    def meet(group: pa.Table) -> pa.Table:
        value, i, j = (group[c][0].as_py() for c in ("value", "i", "j"))
        block = group["block"].to_numpy()
        cid, n, label, common = (group[c].to_numpy() for c in ("cid", "n", "label", "common"))
        flat = group["prefix"].combine_chunks()
        who = np.repeat(np.arange(cid.size), np.diff(flat.offsets.to_numpy()))
        held = flat.flatten().to_numpy()
        # Incidence of the values that come before this one: classes with one in common meet there already.
        before = held < value
        names, at = np.unique(held[before], return_inverse=True)
        earlier = np.zeros((cid.size, names.size), dtype=np.float32)
        earlier[who[before], at] = 1
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        ok = (earlier[left] @ earlier[right].T == 0) & (label[left][:, None] != label[right][None, :])
        small, large = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
        ok &= 100 * small >= percent * large
        # Two sets of these sizes are linked from percent / (100 + percent) of both sizes in common on.
        ok &= (100 + percent) * np.minimum.outer(common[left], common[right]) >= percent * (small + large)
        if i == j:
            ok &= cid[left][:, None] < cid[right][None, :]
        left, right, ok = left[ok.any(axis=1)], right[ok.any(axis=0)], ok[ok.any(axis=1)][:, ok.any(axis=0)]
        if not left.size:
            return schema.empty_table()
        row = (value, i, j, cid[left], cid[right], label[right], np.packbits(ok).tobytes())
        return pa.Table.from_arrays([pa.array([c], t) for c, t in zip(row, schema.types)], schema=schema)

    return spread.groupBy("value", "i", "j").applyInArrow(
        meet, "value bigint, i int, j int, lefts array<bigint>, rights array<bigint>, labels array<bigint>, mask binary")


def alone(sets: DataFrame, cids: DataFrame) -> DataFrame:
    """(cid, own): shingles of each class's full set that no other class of ``cids`` holds; none for classes with several sets.

    Shingles are counted by value, combined in the tasks; the few classes' own ones name them, so nothing is joined by value.
    """
    schema = "value bigint, cid bigint"

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            found = [np.frombuffer(x, dtype=np.int64) for x in texts(batch.column(1))]
            cid = np.repeat(batch.column(0).to_numpy(), [x.size for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)), pa.array(cid)], names=["value", "cid"])

    own_sets = sets.join(cids, "cid", "left_semi")
    single = own_sets.groupBy("cid").agg(F.count(F.lit(1)).alias("k")).filter("k = 1").select("cid")
    held = own_sets.select("cid", "hashes").mapInArrow(spelled, schema)
    once = held.groupBy("value").agg(F.count(F.lit(1)).alias("k"), F.min("cid").alias("cid")).filter("k = 1")
    return once.groupBy("cid").agg(F.count(F.lit(1)).alias("own")).join(single, "cid", "left_semi")


def able(long: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``long`` whose class may be linked with another one of its list, with ``common`` and new list lengths."""
    own = written(alone(sets, long.select("cid").distinct()), "own")
    common = long.join(own, "cid", "left").withColumn("common", F.col("n") - F.coalesce("own", F.lit(0).cast("bigint"))).drop("own", "m")
    least = common.groupBy("value").agg(F.min("n").alias("least"))
    # The smallest set that it can be linked with: not below percent of its own size, nor below the list's smallest.
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    stay = written(common.join(least, "value").filter((100 + percent) * F.col("common") >= percent * (F.col("n") + partner)).drop("least"), "able")
    lengths = (stay.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"))
               .filter("lo < hi").select("value", "m"))
    return stay.join(lengths, "value")


def links(docs: DataFrame, classes: DataFrame, shingle: int, k: int, percent: int, id_col: str,
          text_col: str) -> DataFrame:
    """Verified links (a, b) between classes: enough of them to connect every two linked classes."""
    held = written(prefixes(classes, k, percent), "prefixes")
    posted = held.select(F.explode("prefix").alias("value"), "cid", "n")
    lists = posted.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.min("cid").alias("pivot")).filter("m > 1")
    listed = written(posted.join(lists, "value"), "lists")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingle_set(t, shingle).tobytes() for t in texts(batch.column(1))], pa.binary())],
                names=["cid", "hashes"])

    # Full sets of the classes in lists only, from their texts.
    sets = written(docs.select(F.col(id_col).cast("bigint").alias("cid"), F.col(text_col).cast("string").alias("text"))
                   .join(listed.select("cid").distinct(), "cid", "left_semi")
                   .mapInArrow(sets_of, "cid bigint, hashes binary").dropDuplicates(), "sets")

    star = listed.filter("cid <> pivot").select(F.col("pivot").alias("x"), F.col("cid").alias("y"), F.col("cid").alias("label")).distinct()
    first = written(verified(bucketed(star), ["bucket"], sets, k, percent), "links")
    labels = written(components(first), "labels")

    # Lists of two have met in full.
    labelled = (listed.filter("m > 2").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
                .withColumn("label", F.coalesce("component", "cid")).drop("component"))
    mixed = labelled.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("value")
    rest = written(labelled.join(mixed, "value"), "rest")
    short = rest.filter(F.col("m") <= SHORT)
    one, two = short.alias("one"), short.alias("two")
    pairs = (one.join(two, (F.col("one.value") == F.col("two.value")) & (F.col("one.cid") < F.col("two.cid"))
                      & (F.col("one.label") != F.col("two.label")) & (F.col("one.cid") != F.col("one.pivot"))
                      & (F.least("one.n", "two.n") * 100 >= F.greatest("one.n", "two.n") * percent))
             .select(F.col("one.cid").alias("x"), F.col("two.cid").alias("y"), F.col("two.label").alias("label")).distinct())
    second = verified(bucketed(pairs), ["bucket"], sets, k, percent)
    long = written(rest.filter(F.col("m") > SHORT).join(held.select("cid", "prefix"), "cid"), "long")
    blocks = written(block_pairs(able(long, sets, percent), percent), "blocks")
    third = verified(blocks, ["value", "i", "j"], sets, k, percent)
    return first.unionByName(second).unionByName(third)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, k: int = K,
           percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, digest), one row per input row."""
    rows = written(sketched(docs, shingle, k, id_col, text_col), "sketches")
    named = rows.filter("doc_id IS NOT NULL AND n > 0")
    classes = written(named.groupBy("digest", "n", "sketch").agg(F.min("doc_id").alias("cid")), "classes")
    found = components(links(docs, classes.select("cid", "n", "sketch"), shingle, k, percent, id_col, text_col))
    by_class = (classes.select("digest", "cid").join(found.withColumnRenamed("node", "cid"), "cid", "left")
                .select("digest", F.coalesce("component", "cid").alias("component_id")))
    grouped = named.select("doc_id", "n", "digest").join(by_class, "digest")
    alone = (rows.filter("doc_id IS NULL OR n = 0").select("doc_id", "n", "digest")
             .withColumn("component_id", F.col("doc_id")))
    same: Column = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return (grouped.select(*alone.columns).unionByName(alone)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", same.alias("kept"), "digest"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, k: int = K,
          percent: int = PERCENT) -> DataFrame:
    """The input rows whose document stays, one of each group, with all their columns; rows without an id stay."""
    stay = (groups(docs, id_col, text_col, shingle, k, percent).filter("kept AND doc_id IS NOT NULL")
            .select(F.col("doc_id").alias("id")).distinct())
    ident = F.col(id_col).cast("bigint")
    rows = wrapped(docs, id=ident)
    kept = rows.join(stay, "id", "left_semi").dropDuplicates(["id"])
    return kept.select("row.*").unionByName(rows.filter("id IS NULL").select("row.*"))
