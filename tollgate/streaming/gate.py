"""Run a fused check suite on every micro-batch of a Structured Streaming query.

The reference is batch only; this adds no operator, it only lets the same
suite gate data as it lands.  Each micro-batch is checked with one aggregation
pass and its result rows are written (with the batch id as run name) to the
batch's own folder of the result store.  ``foreachBatch`` may replay a batch
after a failure; the replay overwrites the same folder, so each batch's rows
are there once.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.suite import Check, run_suite
from ..session import shared_path


def gate_stream(stream: DataFrame, checks: Sequence[Check], table: str, layer: str, results_path: str | None = None,
                checkpoint: str | None = None, trigger_once: bool = False):
    """Start a streaming query that writes suite results for each micro-batch."""
    spark = stream.sparkSession
    results_path = results_path or shared_path(spark, "dq_results_stream")
    checkpoint = checkpoint or shared_path(spark, "checkpoints", f"gate_{layer}_{table}")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        res = run_suite(batch, checks, table, layer).withColumn("run_name", F.lit(f"batch-{batch_id}-{layer}-gate"))
        res.write.mode("overwrite").parquet(f"{results_path.rstrip('/')}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
