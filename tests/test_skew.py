"""A key holding a third of the rows: results stay exact and the hot key is spread."""
from pyspark.sql import functions as F

from tollgate.operators import completeness as C
from tollgate.operators import consistency as K
from tollgate.operators import skew as SK
from tollgate.plans import suite as S


def _skewed(spark, n=30000):
    # every third row refers to key 7; the rest to 1000..1999 (1500.. are orphans)
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 1000).alias("fk"))


def _shuffled(spark, df):
    """Rows of the frame that *df* makes, collected with broadcasting off."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_membership_is_exact_without_broadcast(spark):
    child = _skewed(spark)
    parent = spark.range(0, 1500).select(F.col("id").alias("pk"))
    marked = _shuffled(spark, lambda: SK.mark_membership(child, "fk", parent, "pk"))
    assert len(marked) == 30000 and sum(r["__hit"] is None for r in marked) == 10000
    keys = {r["pk"] for r in parent.collect()}
    want = sum(1 for r in child.collect() if r["fk"] not in keys)
    assert len(_shuffled(spark, lambda: K.referential_integrity(child, "k", "fk", parent, "pk"))) == want


def test_parent_keys_may_repeat(spark):
    child = _skewed(spark, 3000)
    parent = spark.range(0, 3000).select((F.col("id") % 1500).alias("pk"))
    assert SK.mark_membership(child, "fk", parent, "pk").count() == 3000
    assert SK.keep_matching(child, "fk", parent, "pk").count() == 2000


def test_null_keys_are_spread(spark):
    child = spark.range(20000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("fk"))
    parent = spark.range(10).select(F.col("id").alias("pk"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, ("-1", "false"), strict=True):
            spark.conf.set(n, v)
        per_task = SK.missing(child, "fk", parent, "pk").filter("fk IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
    assert sum(r["count"] for r in per_task) == 10000 and max(r["count"] for r in per_task) < 10000 / 4


def test_uniqueness_and_suite_relationship_on_hot_keys(spark):
    child = _skewed(spark)
    dup = C.pk_unique(child, "fk").filter(F.col("fk") == 7).first()
    assert dup["n_rows"] == 10000
    parent = spark.range(0, 1500).select(F.col("id").alias("fk"))
    r = S.run_suite(child, [S.Check("relationship", "fk", {"parent": parent, "pk": "fk"})], "c", "bronze").first()
    assert (r["evaluated_rows"], r["failing_rows"]) == (30000, 10000)


def test_keep_matching_null_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "a")], "k int, v string")
    keys = spark.createDataFrame([("a",), (None,)], "v string")
    for semi, anti in ((SK.keep_matching(df, "v", keys, "v"), SK.keep_matching(df, "v", keys, "v", keep=False)),):
        both = [{r["k"] for r in semi.collect()}, {r["k"] for r in anti.collect()}]
        assert both == [{1, 4}, {2, 3}] == [{r["k"] for r in _shuffled(spark, lambda d=d: d)} for d in (semi, anti)]  # null never matches; left-anti keeps it


def test_rows_without_the_keys_are_split_off(spark):
    rows = spark.range(20000).select(F.col("id").alias("n"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("K"), F.col("id").cast("string"))).alias("k"))
    keys = rows.where("n % 100 = 7").select("k").union(spark.createDataFrame([(None,), ("other",)], "k string"))
    may, none = SK.split_by(rows, "k", keys, "k")
    assert may.columns == none.columns == rows.columns
    a, b = {r.n for r in may.collect()}, {r.n for r in none.collect()}
    assert a | b == set(range(20000)) and not a & b
    assert {n for n in range(20000) if n % 100 == 7} <= a and len(a) < 400  # nulls and nearly all others are off
    zero = spark.createDataFrame([(-0.0,), (1.0,)], "x double")  # equal doubles may hash apart: none is split off
    may, none = SK.split_by(zero, "x", spark.createDataFrame([(0.0,)], "x double"), "x")
    assert may.count() == 2 and none.count() == 0
