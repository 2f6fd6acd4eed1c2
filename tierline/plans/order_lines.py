"""Typed order lines, bucketed by order id beside the orders' states: the product report without a
shuffle of raw items.

Each item of an order is parsed once, when its batch is refined.  Both tables only grow.  A line counts
(``raw``) for the raw copy it came in, and (``latest``) +1 when its copy becomes the order's current one
and -1 when another takes its place, so both forms of the report are sums; an order's status is the one
of the highest ``seq``.  Rows carry the attempt that wrote them, and the refresh's commit names the attempts that
were finished, so what a failed one left is never read.  More than ``MAX_ATTEMPTS`` are rewritten
by building the tables anew.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.columns import FAILED_STATUS
from tierline.functions.items import raw_items, to_int_lax
from tierline.operators.reports import REVENUE
from tierline.sources.buckets import BucketedTable
from tierline.sources.tables import TierStore

MAX_ATTEMPTS = 32
LINES = "order_id string, product_id string, product_name string, revenue double, raw int, latest int, attempt string"
STATES = "order_id string, status string, seq long, attempt string"


def tables(store: TierStore, folder: str) -> tuple[BucketedTable, BucketedTable]:
    base = f"{store.folder('silver', 'order_lines')}/{folder}"
    return (BucketedTable(f"{base}/lines", LINES, "order_id", store.buckets),
            BucketedTable(f"{base}/states", STATES, "order_id", store.buckets))


def lines_of(raw_orders: DataFrame, raw: int | str = 0, latest: int | str = 0) -> DataFrame:
    """The typed lines of raw orders that have an id; ``raw`` and ``latest`` are what each counts for, or columns of that."""
    counts = [(F.col(n) if isinstance(n, str) else F.lit(n)).alias(c) for c, n in (("raw", raw), ("latest", latest))]
    items = (raw_orders.filter(F.col("order_id").isNotNull()).select("order_id", "items", *counts)
             .select("order_id", F.explode(raw_items("items")).alias("it"), "raw", "latest"))
    revenue = to_int_lax(F.col("it.quantity")) * F.col("it.unit_price").try_cast("double")
    return items.select("order_id", F.col("it.product_id").alias("product_id"), F.col("it.product_name").alias("product_name"),
                        revenue.alias("revenue"), "raw", "latest")


def weighed(copies: DataFrame, current: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """(order_id, items, raw, latest) of raw orders: each text once, however many copies have it, and whether or not
    it is also the order's current one; texts that count for nothing are left out."""
    said = [(copies, 1, 0), (current, 0, 1)] + ([(replaced, 0, -1)] if replaced is not None else [])
    return reduce(DataFrame.unionByName, [df.select("order_id", "items", F.lit(raw).alias("raw"), F.lit(latest).alias("latest"))
                                          .filter(F.col("order_id").isNotNull()) for df, raw, latest in said])


def counted_once(texts: DataFrame) -> DataFrame:
    return (texts.groupBy("order_id", "items").agg(F.sum("raw").cast("int").alias("raw"), F.sum("latest").cast("int").alias("latest"))
            .filter("raw <> 0 OR latest <> 0"))


def add(store: TierStore, folder: str, seq: int, copies: DataFrame, current: DataFrame,
        replaced: DataFrame | None, states: DataFrame) -> str:
    """Add the raw ``copies`` that landed, the orders' new ``current`` copies and those they ``replaced``, and the
    refined ``states`` of the former; returns the attempt that a commit has to name."""
    attempt = uuid.uuid4().hex
    lines, known = tables(store, folder)
    # Grouped where the shuffle by bucket has put them.
    lines.append_dealt(lines_of(counted_once(lines.dealt(weighed(copies, current, replaced))), "raw", "latest"), attempt=attempt)
    known.append(states.select("order_id", "status", F.lit(seq).cast("long").alias("seq")), attempt=attempt)
    return attempt


def report_top_products(lines: DataFrame, states: DataFrame, n: int = 10, dedupe_items: bool = False) -> DataFrame:
    """``reports.report_top_products`` from the bucketed tables: lines meet their order's status and sum up
    per order and product inside their bucket; only these sums are shuffled, by product."""
    good = (states.groupBy("order_id").agg(F.max_by("status", "seq").alias("status"))
            .filter(F.col("status") != F.lit(FAILED_STATUS)).select("order_id"))
    count = F.col("latest" if dedupe_items else "raw")
    exact = F.col("revenue").try_cast(REVENUE)
    product = ["product_id", "product_name"]
    per_order = (lines.filter(count != 0).join(good, "order_id", "left_semi").groupBy("order_id", *product).agg(
        F.sum(count).alias("copies"),
        F.sum(F.when(F.col("revenue").isNotNull(), count)).alias("known"),
        F.sum(F.when(exact.isNotNull(), count)).alias("fit"),
        F.try_sum(exact * count).alias("exact"),
        F.sum(F.col("revenue") * count).alias("plain")).filter("copies > 0"))
    total = F.when(F.coalesce(F.sum("known"), F.lit(0)) == 0, F.lit(None).cast("double")).otherwise(F.coalesce(
        F.when(F.sum("known") == F.coalesce(F.sum("fit"), F.lit(0)), F.try_sum("exact")).cast("double"), F.sum("plain")))
    return (per_order.groupBy(*product).agg(total.alias("total_revenue"), F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in product]).limit(n))


def read(spark: SparkSession, store: TierStore, commit) -> tuple[DataFrame, DataFrame]:
    """(lines, states) of the finished attempts, and the lines of raw copies whose batches are
    not among them (still to be refined, or never finished for want of statistics)."""
    from tierline.plans import incremental as inc
    lines, states = (t.read(spark).filter(F.col("attempt").isin(commit.attempts)) for t in tables(store, commit.lines))
    if rest := sorted(inc.landed_batches(spark, store, commit), key=str):
        copies = store.read(spark, "bronze", "orders", partitions=True).filter(inc.in_batches(rest))
        lines = lines.unionByName(lines_of(copies, raw=1).withColumn("attempt", F.lit(None).cast("string")))
    return lines, states
