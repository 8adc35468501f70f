"""Written tables in the cluster's shared folder; they cut lineage and survive lost executors."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import shared_path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (never machine-local on a cluster)."""
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write *df* as Parquet in the shared folder and return the reread table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_rows(df: DataFrame, base: str = "_row_key") -> tuple[DataFrame, str]:
    """*df* with a key of each row, written, so that it stays the same whenever a task is run again, and the name of its
    column, which no column of *df* has."""
    name, taken = base, {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return settle(df.withColumn(name, F.monotonically_increasing_id()), "keyed"), name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
