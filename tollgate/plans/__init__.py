"""Check suites compiled into fused Spark plans, gates, and the query registry."""
