"""Key membership: which child rows have their key in a parent table.

Plain semi, anti and left joins, so each child row is shuffled once.  A foreign key that holds a third of the rows makes one
large child partition, which adaptive execution splits (it may split the left
side of semi and anti joins when the other side is a plain shuffle, as here).
Null keys match nothing; they get a spread value of their own, so they never
share a partition.  Whether a parent is broadcast is left to Spark, which
decides from measured bytes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 4096  # null keys are dealt over this many join keys
FILTER_WORDS = 1 << 20  # 64-bit words of the filter of `split_by`, whatever the table
_PLAIN = ("string", "boolean", "date", "timestamp", "timestamp_ntz", "tinyint", "smallint", "int", "bigint")  # equal values, equal hashes


def _keys(parent: DataFrame, pk: str) -> DataFrame:
    return parent.select(F.col(pk).alias("__pk")).dropna()


def _spread(child: DataFrame, fk: str):
    """0 for rows with a key; rows without one are dealt over `NULL_SPREAD` values."""
    return F.when(F.col(fk).isNull(), F.pmod(F.xxhash64(*child.columns), F.lit(NULL_SPREAD))).otherwise(F.lit(0)).cast("bigint")


def matching(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose (non-null) key occurs in ``parent[pk]``; keys are compared as they are."""
    k = _keys(parent, pk)
    c = child.filter(F.col(fk).isNotNull())
    return c.join(k, c[fk] == k["__pk"], "left_semi")


def missing(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key does not occur in ``parent[pk]``; null keys are missing."""
    c = child.withColumn("__spread", _spread(child, fk))
    # always 0, but no constant: both columns stay join keys
    k = _keys(parent, pk).withColumn("__zero", F.pmod(F.xxhash64("__pk"), F.lit(1)).cast("bigint"))
    return c.join(k, (c[fk] == k["__pk"]) & (c["__spread"] == k["__zero"]), "left_anti").drop("__spread")


def mark_membership(child: DataFrame, fk: str, parent: DataFrame, pk: str, flag: str = "__hit", unique: bool = False) -> DataFrame:
    """``child`` + boolean ``flag``: true when the key occurs in the parent, else null.  One left join, so the child is read
    once; *unique* promises that the parent's keys do not repeat and saves reducing them.  With a unique parent that is
    read from a table both sides are plain shuffles, and a hot key's partition of the child can be split."""
    keys = _keys(parent, pk) if unique else _keys(parent, pk).distinct()
    # null keys match nothing and are spread; __zero is always 0, but no constant: both columns stay join keys
    keys = keys.withColumn("__zero", F.pmod(F.xxhash64("__pk"), F.lit(1)).cast("bigint")).withColumn(flag, F.lit(True))
    c = child.withColumn("__spread", _spread(child, fk))
    return c.join(keys, (c[fk] == keys["__pk"]) & (c["__spread"] == keys["__zero"]), "left").select(*[c[x] for x in child.columns], flag)


def split_by(df: DataFrame, col: str, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of *df* that may hold one of ``keys[key]``, rows that hold none), by a filter of the keys' hashes of fixed
    size, which is broadcast.  The second stay where they are, so only the first need a shuffle; a full filter calls
    every row possible and changes no result.  Rows with a null in *col* hold none.  Keys of types whose equal values
    may hash apart (floats, nested types, collated text) are not filtered.  *keys* is read, so it is best written."""
    if dict(df.dtypes)[col] not in _PLAIN or dict(keys.dtypes)[key] != dict(df.dtypes)[col]:
        return df, df.where(F.lit(False))

    def spot(c):
        return F.pmod(F.xxhash64(c), F.lit(FILTER_WORDS * 64))

    bit = F.expr("shiftleft(1L, CAST(__spot & 63 AS INT))")
    words = (keys.where(F.col(key).isNotNull()).select(spot(key).alias("__spot"))
             .groupBy(F.expr("shiftright(__spot, 6)").alias("__word")).agg(F.bit_or(bit).alias("__bits")))
    joined = df.withColumn("__spot", F.when(F.col(col).isNotNull(), spot(col)))
    joined = joined.join(F.broadcast(words), F.expr("shiftright(__spot, 6)") == words["__word"], "left")
    may = F.coalesce((F.col("__bits").bitwiseAND(bit)) != 0, F.lit(False))
    return joined.where(may).select(*df.columns), joined.where(~may).select(*df.columns)


def keep_matching(df: DataFrame, col: str, keys: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Semi join (``keep``) or anti join (not ``keep``; null keys stay) of ``df`` with ``keys[key]``."""
    return (matching if keep else missing)(df, col, keys, key)
