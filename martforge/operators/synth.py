"""Keyed synthetic rows and hierarchy expansion, repeatable and distributed.

Random draws of the original generators (a random reference id per row, a
random number of items per category, a random sample) are replaced by
arithmetic hashes of keys, so reruns and other engines give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.ids import dense_index
from martforge.functions.sizing import checked_broadcast

# Knuth's multiplicative hash constant, its 32-bit modulus, and the
# 31-bit key reduction that keeps key * constant below 2^63 for any bigint key.
KNUTH = 2654435761
MOD32 = 4294967296
MOD31 = 2147483648


def hash_bucket(key: Column, k: Column | int, base: int = 1) -> Column:
    """``((((key mod 2^31) * 2654435761) mod 2^32) >> 16) mod k + base``: even spread, no
    overflow for any bigint key, same in any SQL engine."""
    reduced = F.pmod(key.cast("bigint"), F.lit(MOD31))
    mixed = F.shiftright(F.pmod(reduced * F.lit(KNUTH), F.lit(MOD32)), 16)
    kk = k if isinstance(k, Column) else F.lit(k)
    return (F.pmod(mixed, kk.cast("bigint")) + F.lit(base)).cast("bigint")


def keyed_rows(keys: DataFrame, key: str, ref: DataFrame, ref_id: str, ref_cols: dict[str, str],
               country: str, name_prefix: str = "Store_", addr_prefix: str = "Address_",
               addr_suffix: str = " Main Road") -> DataFrame:
    """One store row per key, assigned to reference row ``hash(key) mod count(ref) + 1``.

    ``ref`` must carry dense ids 1..count(ref) in ``ref_id``; ``ref_cols`` maps
    output column -> ref column. The count is a scalar subquery, the reference
    table is broadcast behind a size check.
    """
    k = ref.select(F.count(F.lit(1))).scalar()
    rows = keys.select(F.col(key).alias("store_id"), hash_bucket(F.col(key), k).alias("__geo"))
    r = checked_broadcast(ref.select(F.col(ref_id).cast("bigint").alias("__geo"),
                                     *[F.col(v).alias(o) for o, v in ref_cols.items()]))
    sid = F.col("store_id").cast("string")
    return rows.join(r, "__geo").select(
        "store_id",
        F.concat(F.lit(name_prefix), sid).alias("store_name"),
        F.concat(F.lit(addr_prefix), sid, F.lit(addr_suffix)).alias("store_addr"),
        *[F.col(o) for o in ref_cols],
        F.lit(country).alias("store_country"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: str = "seed") -> DataFrame:
    """``n`` rows in a repeatable pseudo-random order (md5 of key and seed): top-k per
    partition, then a merge of k rows per partition."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    return df.orderBy(order, F.col(key)).limit(n)


def expand_hierarchy(categories: DataFrame, dept: str, cat: str, min_items: int = 10, max_items: int = 20,
                     first_id: int = 10000, prefix: str = "ITM") -> DataFrame:
    """``min_items..max_items`` items per (department, category), item ids running from ``first_id``
    in (department, category, position) order; item name = word + category without its last char."""
    cats = dense_index(categories.select(dept, cat).distinct(),
                       [F.col(dept).asc_nulls_first(), F.col(cat).asc_nulls_first()], "__cat_rank", base=1)
    span = max_items - min_items + 1
    n = hash_bucket(F.col("__cat_rank"), span, base=min_items)
    items = cats.select(dept, cat, F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("__pos"))
    numbered = dense_index(items, [F.col(dept).asc_nulls_first(), F.col(cat).asc_nulls_first(),
                                   F.col("__pos").asc()], "__item_no", base=first_id)
    # The first letter of the whole text, not of each word.
    low = F.lower(F.col(dept))
    word = F.concat(F.upper(F.substring(low, 1, 1)), F.substr(low, F.lit(2)))
    short = F.expr(f"substring({cat}, 1, length({cat}) - 1)")
    return numbered.select(
        F.col(dept).alias("department"), F.col(cat).alias("category"),
        F.concat(F.lit(prefix), F.col("__item_no").cast("string")).alias("item_id"),
        F.concat(word, F.lit(" "), short).alias("item_name"))
