"""Event metadata as a Variant column: parsed once, stored shredded, read path by path.

Parquet keeps the paths that most rows of a file have as typed columns of their own (shredding, which Spark
infers), so a query on a path reads that column and no JSON text is parsed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_variants(clean_events: DataFrame) -> DataFrame:
    """``event_id``, time and metadata of refined events; metadata that is no JSON is NULL."""
    return clean_events.select("event_id", "event_type", "event_timestamp",
                               F.try_parse_json("metadata_json").alias("metadata_variant"))


def metadata_paths(variants: DataFrame, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """One column a path (name → JSON path and type): NULL where the path is absent, its value is of another
    kind, or there is no metadata."""
    return variants.select("event_id", *[F.try_variant_get("metadata_variant", path, kind).alias(name)
                                         for name, (path, kind) in paths.items()])
