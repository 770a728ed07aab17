"""strata: a Spark-native medallion engine for coded time-series data.

Layers: ``sources`` (tables, fixtures, files, manifests, sinks), ``streaming``
(bronze ingestion), ``functions`` (column expressions), ``operators``
(dedup, quality gates, joins, aggregates, rankings, reconciliation) and
``plans`` (silver/gold tables, analyst questions, SQL twins, the query registry).
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
