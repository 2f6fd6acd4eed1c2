"""Latest-row-per-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_col`` (NULLs last).

    Rows tied on ``order_col`` are resolved by ``tiebreak`` columns ascending, so the result is
    repeatable.  ``row_number() == 1`` is planned as a window group limit: each map task
    keeps only its best row per key before the shuffle, so a key with millions of redelivered
    copies costs one row of shuffle per task, not millions.
    """
    w = _newest_first(keys, order_col, tiebreak)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def repeats(keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> Column:
    """Whether a row's key has another row before it.  Over the result of :func:`latest_per_key` with the same
    arguments it needs no shuffle and no sort: the rows stand as the window wants them."""
    return F.row_number().over(_newest_first(keys, order_col, tiebreak)) > 1


def comes_before(order_col: str, tiebreak: Sequence[str], other: str) -> Column:
    """Whether a row comes before the row in its struct column ``other`` in the order of :func:`latest_per_key`;
    not where the two are equal in all of it."""
    before = F.lit(False)
    for name in reversed([order_col, *tiebreak]):
        mine, its = F.col(name), F.col(other)[name]
        before = (F.when(mine.eqNullSafe(its), before).when(mine.isNull(), F.lit(False)).when(its.isNull(), F.lit(True))
                  .otherwise(mine > its if name == order_col else mine < its))
    return before


def _newest_first(keys: Sequence[str], order_col: str, tiebreak: Sequence[str]) -> WindowSpec:
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tiebreak]
    return Window.partitionBy(*keys).orderBy(*order)
