"""Tables bucketed by a column: joins and groupings on it need no shuffle.

A bucketed table is a folder of Parquet files whose names hold their bucket.  A session knows of the
buckets through a catalog entry that points at the folder; it is made on first use, so the
folder is all that has to survive.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.sources.tables import COMPRESSION


@dataclass(frozen=True)
class BucketedTable:
    path: str
    columns: str
    key: str
    buckets: int

    @property
    def name(self) -> str:
        return "bucketed_" + hashlib.md5(self.path.encode()).hexdigest()

    def _names(self) -> list[str]:
        return [c.strip().split(" ")[0] for c in self.columns.split(",")]

    def _known(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}) USING parquet OPTIONS (compression '{COMPRESSION['parquet']}') "
                  f"CLUSTERED BY ({self.key}) "
                  f"SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def dealt(self, df: DataFrame) -> DataFrame:
        """A task a bucket, by the key."""
        return df.repartition(self.buckets, self.key)

    def append(self, df: DataFrame, **same) -> None:
        """Add rows: one file a bucket, sorted by the key.  Columns that are the ``same`` value in all of them are
        given by name, as they need no shuffle."""
        self.append_dealt(self.dealt(df.select(*[n for n in self._names() if n not in same])), **same)

    def append_dealt(self, rows: DataFrame, **same) -> None:
        """Add rows that still lie as :meth:`dealt` put them."""
        self._known(rows.sparkSession)
        names = self._names()
        (rows.select(*[F.lit(same[n]).alias(n) if n in same else n for n in names]).write.mode("append").format("parquet")
         .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name))

    def read(self, spark: SparkSession) -> DataFrame:
        self._known(spark)
        spark.catalog.refreshTable(self.name)  # files that another session added
        return spark.table(self.name)
