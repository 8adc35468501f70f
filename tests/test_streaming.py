import tempfile

from tollgate.plans import suite as S
from tollgate.streaming import gate_stream


def test_gate_stream_writes_results_per_batch(spark, bronze_parts):
    src = tempfile.mkdtemp(prefix="tollgate-stream-src-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="tollgate-stream-out-", dir="/tmp")
    bronze_parts.write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(bronze_parts.schema).parquet(src + "/in")
    checks = [S.Check("between", "unit_price", {"min": 0.01}), S.Check("not_null", "supplier_id")]
    q = gate_stream(stream, checks, "parts", "bronze", results_path=out + "/r", checkpoint=out + "/ck", trigger_once=True)
    q.awaitTermination(120)
    res = {r["column_name"]: r for r in spark.read.parquet(out + "/r").collect()}
    assert res["unit_price"]["failing_rows"] == 1 and res["supplier_id"]["failing_rows"] == 1
