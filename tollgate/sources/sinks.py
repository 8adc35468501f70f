"""Sinks: materialise layers, store check results.

Written tables go under the shared folder named by ``spark.checkpoint.dir``
(never a machine-local temp folder on a cluster), which also cuts lineage: a
re-read table restarts the plan from files, so a lost executor recomputes from
the written layer, not from bronze.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

# How each layer is materialised and tagged.
LAYER_TAGS = {"bronze": ["bronze", "raw"], "silver": ["silver", "cleansed"], "gold": ["gold", "curated"]}


def layer_schema(spark: SparkSession, layer: str, prefix: str = "tollgate_") -> str:
    """The catalog schema of a layer, made on first use under the shared folder."""
    name = f"{prefix}{layer.lower()}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{shared_path(spark, 'schemas', name)}'")
    return name


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def materialize_layer(
    spark: SparkSession,
    df: DataFrame,
    layer: str,
    table: str,
    root: str | None = None,
    partition_by: Sequence[str] = (),
    view: bool | None = None,
) -> DataFrame:
    """bronze → temp view (lazy); silver / gold → Parquet table in the catalog schema of the layer, re-read.

    The table carries its layer's tags as table properties (``layer``, ``tags``).  ``partition_by`` lays files out for
    partition pruning (e.g. metric_month).  Materialising a table again points its name at the new files.
    """
    if view if view is not None else layer.lower() == "bronze":
        df.createOrReplaceTempView(f"{layer}_{table}")
        return df
    # a folder of its own for each call: a frame that an earlier call returned stays readable
    path = f"{(root or shared_path(spark, 'layers')).rstrip('/')}/{layer}/{table}/{uuid.uuid4().hex}"
    name = f"{layer_schema(spark, layer)}.{table}"
    w = df.write.format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files of earlier calls stay
    w.saveAsTable(name)
    tags = ",".join(LAYER_TAGS.get(layer.lower(), [layer.lower()]))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('layer' = '{layer.lower()}', 'tags' = '{tags}')")
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(f"{layer}_{table}")
    return out


def passthrough_model(df: DataFrame) -> DataFrame:
    """``SELECT * FROM ref(x)``: a projection Catalyst collapses away."""
    return df.select("*")


def store_results(spark: SparkSession, results: DataFrame, run_name: str, root: str | None = None) -> DataFrame:
    """Append suite results with their run name, in folders by layer and run id;
    return this run's rows.  The id is unique, so runs of one name stay apart,
    and the filter on it prunes every other run's folder."""
    path = root or shared_path(spark, "dq_results")
    run_id = uuid.uuid4().hex
    stored = results.withColumn("run_name", F.lit(run_name)).withColumn("run_id", F.lit(run_id))
    stored.write.mode("append").partitionBy("layer", "run_id").parquet(path)
    return spark.read.parquet(path).filter(F.col("run_id") == run_id)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write *df* as JSON lines, one file a task, and read it back by its own schema."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def write_json_totals(df: DataFrame, path: str) -> None:
    write_json(df, path)
