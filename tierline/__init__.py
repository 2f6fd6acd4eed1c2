"""tierline — a Spark-native tiered (raw → refined → aggregate → report) event and order pipeline.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects; nothing in the
library collects rows to the driver.  Wall-clock reads are replaced by an explicit ``as_of``.

Sub-packages:

* ``tierline.functions``  column-level building blocks (validation rules, JSON item parsing,
  rounding, segment labels)
* ``tierline.operators``  DataFrame → DataFrame operators (dedup, refined and aggregate
  tables, reports, envelopes, quality checks)
* ``tierline.sources``    table IO, driver-table adapters, topic records
* ``tierline.streaming``  Structured Streaming ingest with a dead-letter sink
* ``tierline.plans``      the scheduled refresh and the registered query catalogue
"""

from tierline.session import get_spark

__all__ = ["get_spark"]
