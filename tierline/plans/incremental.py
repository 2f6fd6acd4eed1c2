"""Incremental refinement without a scan of the history.

Beside the refined tables the store keeps, for events and for orders, the **current raw row** of every
id (also of ids whose current row the model drops), in hash buckets of the id.  A refinement reads the raw rows of the
new batches, of the current rows only the buckets that these ids fall into, and decides by
the same ordering as a full refresh which row is the latest now.  Where the new row is, the id has
*changed*: what the model made of its old row is taken back, what it makes of the new one is
added.  Of the refined tables only the periods (days of events, months of orders) that such a row left or
entered are rewritten.

The current rows are a log: each refinement adds its changed rows as a part (``seq``), an id's latest
row counts, and a log of more than ``MAX_PARTS`` parts is rewritten as one.

**Finishing.**  Everything a refinement writes carries its number ``seq`` and is read only once a commit
(one small table, replaced atomically) names that number.  A failed attempt is done again under the same
number, over what it left: the same current rows give the same changes, and the periods it meant to
rewrite were noted before (``refine_intent``).  Which batches are done is a high-water mark a streaming query
and the few batches beyond it, so nothing grows with the number of batches ever landed.

A full refresh rebuilds the current rows too.  A store that has none (none was finished yet, or a
full refresh failed in between) is refreshed in full whatever was asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import bitmaps, gold, quality, silver
from tierline.operators.dedup import comes_before, latest_per_key, repeats
from tierline.plans import order_lines
from tierline.sources.tables import PARTITIONING, TierStore, observed, period_of

#: Parts of the log of current rows before they are rewritten as one.
MAX_PARTS = 32
#: Raw rows of new batches that are few: the current rows of their ids are picked before they are shuffled.
FEW_ROWS = 1 << 16


@dataclass(frozen=True)
class Model:
    raw: str
    refined: str
    winners: str
    key: str
    time: str
    tiebreak: tuple[str, ...]
    refine: Callable  # (latest raw rows, as_of) -> refined rows
    rows: Callable  # refined rows -> rows of the customer's shape

    @property
    def period(self) -> str:
        return next(iter(PARTITIONING["silver", self.refined]))


MODELS = (
    Model("events", "clean_events", "event_winners", "event_id", "timestamp", silver.EVENT_TIEBREAK,
          silver.refine_events, gold.event_rows),
    Model("orders", "validate_orders", "order_winners", "order_id", "created_at", silver.ORDER_TIEBREAK,
          silver.refine_orders, gold.order_rows),
)


# ---------------------------------------------------------------- what is finished

@dataclass
class Commit:
    """The last finished refinement, the last full one (0: none), each query's high-water mark (all
    batches up to it are refined), and refined batches beyond the marks."""

    seq: int = 0
    full: int = 0
    marks: dict = field(default_factory=dict)
    batches: set = field(default_factory=set)
    #: Folder of the bucketed order lines, and the attempts that filled it.
    lines: str | None = None
    attempts: list = field(default_factory=list)

    def add(self, done: list[tuple]) -> None:
        self.batches |= set(done)
        for run in {r for r, _ in self.batches}:
            mark = self.marks.get(run, -1)
            while (run, mark + 1) in self.batches:
                mark += 1
                self.batches.remove((run, mark))
            if mark >= 0:
                self.marks[run] = mark


def read_commit(spark: SparkSession, store: TierStore) -> Commit:
    out = Commit()
    for r in store.read(spark, "silver", "refine_commits").collect():  # a row a streaming query, and a few batches
        if r["what"] == "mark":
            out.marks[r["run"]] = r["number"]
        elif r["what"] == "batch":
            out.batches.add((r["run"], r["number"]))
        elif r["what"] == "lines":
            out.lines = r["run"]
        elif r["what"] == "attempt":
            out.attempts.append(r["run"])
        else:
            setattr(out, r["what"], r["number"])
    return out


def write_commit(spark: SparkSession, store: TierStore, commit: Commit) -> None:
    rows = [("seq", None, commit.seq), ("full", None, commit.full)]
    rows += [("mark", run, n) for run, n in commit.marks.items()]
    rows += [("batch", run, n) for run, n in sorted(commit.batches, key=str)]
    rows += [("lines", commit.lines, 0)] * bool(commit.lines) + [("attempt", a, i) for i, a in enumerate(commit.attempts)]
    store.write(spark.createDataFrame(rows, "what string, run string, number long"), "silver", "refine_commits")


def beyond(commit: Commit):
    """Rows of batches above their query's mark: literals on partition columns."""
    out = F.lit(True)
    for run, mark in commit.marks.items():
        out = out & ~F.coalesce((F.col("run").eqNullSafe(F.lit(run))) & (F.col("batch_id") <= mark), F.lit(False))
    return out


def landed_batches(spark: SparkSession, store: TierStore, commit: Commit) -> dict[tuple, set[str]]:
    """(run, batch_id) of the landed batches that no finished refinement holds, with the tables that
    have them: partition columns only, of the folders above the marks."""
    parts = [store.read(spark, "bronze", t, partitions=True).filter(beyond(commit)).select(F.lit(t).alias("t"), "run", "batch_id")
             for t in ("ingest_stats", *(model.raw for model in MODELS))]
    out: dict[tuple, set[str]] = {}
    for r in reduce(DataFrame.unionAll, parts).distinct().collect():
        out.setdefault((r["run"], r["batch_id"]), set()).add(r["t"])
    return {b: tables for b, tables in out.items() if b not in commit.batches}


def finished(commit: Commit):
    """Rows of batches that finished refinements hold."""
    return ~beyond(commit) | in_batches(sorted(commit.batches, key=str))


def in_batches(batches: list[tuple]):
    """Rows of the batches; literals on partition columns, so other folders are not read."""
    out = F.lit(False)
    for run in {r for r, _ in batches}:
        ids = [b for r, b in batches if r == run and b is not None]
        same = F.col("run").eqNullSafe(F.lit(run))
        out = out | (same & (F.col("batch_id").isin(ids) if ids else F.col("batch_id").isNull()))
    return out


# ---------------------------------------------------------------- current raw rows

def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def current_rows(spark: SparkSession, store: TierStore, model: Model, seq: int, buckets: list[int]) -> DataFrame:
    """The log of current raw rows of some buckets, up to a finished refinement."""
    return store.read(spark, "silver", model.winners, partitions=True).filter(
        (F.col("seq") <= seq) & F.col("bucket").isin(buckets))


def _latest(rows: DataFrame, model: Model) -> DataFrame:
    return latest_per_key(rows, [model.key], model.time, model.tiebreak)


def _in_buckets(rows: DataFrame, model: Model, store: TierStore) -> DataFrame:
    """Laid out for the log: a bucket's rows together, in files of a size that AQE picks."""
    return (rows.withColumn("bucket", bucket_of(model.key, store.buckets)).hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", model.key))


def compact_winners(spark: SparkSession, store: TierStore, model: Model, seq: int) -> None:
    """Rewrite the log as one part, each id's latest row."""
    rows = store.read(spark, "silver", model.winners, partitions=True).filter(F.col("seq") <= seq).drop("seq", "bucket")
    store.write(_in_buckets(_latest(rows, model), model, store).withColumn("seq", F.lit(seq).cast("long")),
                "silver", model.winners)


# ---------------------------------------------------------------- refinements

def refine_all(spark: SparkSession, store: TierStore, as_of, commit: Commit, counted: list[tuple]) -> dict[str, dict]:
    """Rebuild the current rows, the refined tables and the order lines from all raw rows.

    ``counted`` are the new batches that this refinement finishes: they have statistics, so they are whole.
    Returns the violations of the quality rules by refined table, counted while the tables were written: ids
    found twice where the current rows are picked, whose order the check reuses; the other rules in the refined rows."""
    found = {}
    commit.full = 0  # until this one is finished, nothing incremental may build on what is there
    write_commit(spark, store, commit)
    seq = commit.seq + 1
    for model in MODELS:
        raw = store.read(spark, "bronze", model.raw).filter(F.col(model.key).isNotNull())
        latest = _latest(raw, model).withColumn("_again", repeats([model.key], model.time, model.tiebreak))
        winners, again = observed(_in_buckets(latest, model, store).withColumn("seq", F.lit(seq).cast("long")),
                                  {"again": F.count_if("_again")})
        store.write(winners, "silver", model.winners)
        rules = quality.ROW_RULES[model.refined]()
        refined, broken = observed(store.laid_out(model.refine(store.read(spark, "silver", model.winners), as_of),
                                                  "silver", model.refined), rules)
        store.write(refined, "silver", model.refined)
        found[model.refined] = {quality.UNIQUE_RULE[model.refined]: again()["again"], **broken()}
    store.write(spark.createDataFrame([], store.read(spark, "silver", "user_changes", partitions=True).schema),
                "silver", "user_changes")
    commit.add(counted)
    commit.seq = commit.full = seq
    build_lines(spark, store, commit)
    return found


def build_lines(spark: SparkSession, store: TierStore, commit: Commit) -> None:
    """Build the bucketed order lines anew, from the raw copies of finished batches."""
    before = commit.lines
    copies = store.read(spark, "bronze", "orders", partitions=True).filter(finished(commit))
    current = (store.read(spark, "silver", "order_winners", partitions=True)
               .filter(F.col("seq") <= commit.seq).drop("seq", "bucket"))
    if sum(n <= commit.seq for n in store.parts(spark, "silver", "order_winners")) != 1:
        current = _latest(current, MODELS[1])  # one part has an id once
    commit.lines = f"v-{uuid.uuid4().hex}"
    commit.attempts = [order_lines.add(store, commit.lines, commit.seq, copies, current, None,
                                       store.read(spark, "silver", "validate_orders"))]
    for folder in store.line_folders(spark) if before else []:
        if folder not in (before, commit.lines):  # readers of the one before may still run
            store.drop_folder(spark, f"silver/order_lines/{folder}")


def refine_new(spark: SparkSession, store: TierStore, as_of, commit: Commit, batches: list[tuple], counted: list[tuple],
               note: Callable[[str, list], None]) -> dict[str, list]:
    """Refine the rows of the new batches; the periods rewritten, by refined table.  ``counted`` are
    those that this refinement finishes.

    ``note(table, periods)`` is called before any row of these periods moves."""
    seq = commit.seq + 1
    changes, days, logs, attempt = [], {}, [], None
    held: list[DataFrame] = []

    def kept(df: DataFrame) -> DataFrame:
        """Read by each of the tables that a refinement adds to, derived once."""
        held.append(df.persist())
        return held[-1]

    landed = store.read(spark, "bronze", "orders", partitions=True).filter(in_batches(counted))
    try:
        for model in MODELS:
            changed = _changed(spark, store, model, commit, batches, kept)
            if changed is None:
                days[model.refined] = []
                continue
            new, old = changed
            added, gone = kept(model.refine(new, as_of)), kept(model.refine(old, as_of))
            periods = {r[0] for r in added.select(period_of("silver", model.refined))
                       .union(gone.select(period_of("silver", model.refined))).distinct().collect()}  # calendar
            before = _intended(spark, store, model, seq)
            days[model.refined] = sorted(periods | before, key=str)
            # The refined rows of ids that were not known are there only if an attempt before this one got so far.
            logs.append((model, new, added, new if before else old))
            if model.raw == "orders":
                attempt = order_lines.add(store, commit.lines, seq, landed, new, old, added)
            changes += [model.rows(added).withColumn("sign", F.lit(1)), model.rows(gone).withColumn("sign", F.lit(-1))]
        _intend(spark, store, seq, days)
        for model, _, added, ids in logs:
            if days[model.refined]:
                note(model.refined, days[model.refined])
                _replace(spark, store, model, days[model.refined], added, ids)
        if changes:
            store.add_part(reduce(DataFrame.unionByName, changes), "silver", "user_changes", seq)
        for model, new, _, _ in logs:
            store.add_part(_in_buckets(new, model, store), "silver", model.winners, seq)
    finally:
        for df in held:
            df.unpersist()
    commit.seq = seq
    commit.add(counted)
    if attempt:
        commit.attempts.append(attempt)
    return days


def _changed(spark: SparkSession, store: TierStore, model: Model, commit: Commit, batches: list[tuple],
             kept: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame] | None:
    """(current raw rows that the batches bring, the rows they take the place of).

    Both are sides of one frame (``kept`` may persist it) of the latest row of the batches and the latest known row
    of each id, which stand in the same place after their shuffles and so meet without another."""
    rows = (store.read(spark, "bronze", model.raw, partitions=True).filter(in_batches(batches))
            .filter(F.col(model.key).isNotNull()).select(store.read(spark, "bronze", model.raw).columns))
    counts = dict(tuple(r) for r in rows.groupBy(bucket_of(model.key, store.buckets)).count().collect())
    if not counts:
        return None
    known = current_rows(spark, store, model, commit.seq, sorted(counts)).select(rows.columns)
    if sum(counts.values()) <= FEW_ROWS:
        known = known.join(rows.select(model.key), model.key, "left_semi").select(rows.columns)
    known = _latest(known, model).select(F.col(model.key).alias("_id"), F.struct(*rows.columns).alias("_known"))
    both = _latest(rows, model).join(known, F.col(model.key) == F.col("_id"), "left").drop("_id")
    # Of equal rows the known one counts: nothing has changed.
    pairs = kept(both.filter(F.col("_known").isNull() | comes_before(model.time, model.tiebreak, "_known")))
    return pairs.drop("_known"), pairs.filter(F.col("_known").isNotNull()).select("_known.*")


def _replace(spark: SparkSession, store: TierStore, model: Model, periods: list, added: DataFrame,
             changed: DataFrame) -> None:
    """Rewrite the periods of the refined table: without the rows of the ``changed`` ids, with those ``added``."""
    kept = (store.read(spark, "silver", model.refined, partitions=True).filter(on_periods(model.period, periods))
            .join(changed.select(model.key), model.key, "left_anti").select(added.columns))
    store.replace_days(kept.unionByName(added), "silver", model.refined, periods)


def on_periods(column: str, periods: list):
    return F.col(column).isin([d for d in periods if d is not None]) | (
        F.col(column).isNull() if None in periods else F.lit(False))


def _intend(spark: SparkSession, store: TierStore, seq: int, days: dict[str, list]) -> None:
    rows = [(seq, table, d) for table, periods in days.items() for d in periods]
    store.write(spark.createDataFrame(rows, "seq long, table_name string, period date"), "silver", "refine_intent")


def _intended(spark: SparkSession, store: TierStore, model: Model, seq: int) -> set:
    """Periods that a failed attempt at this refinement may have rewritten."""
    rows = store.read(spark, "silver", "refine_intent").filter(
        (F.col("seq") == seq) & (F.col("table_name") == model.refined))
    return {r["period"] for r in rows.collect()}  # calendar


# ---------------------------------------------------------------- bitmaps of users

def refresh_bitmaps(spark: SparkSession, store: TierStore, commit: Commit, days: list | None) -> None:
    """Rebuild the user bitmaps of some days of the refined events; of all days, with fresh numbers,
    for None.

    Users without a number get one first, as the part ``seq`` of the numbers.  A failed attempt leaves
    all its days to the next one, which numbers its users again: no other day knows them."""
    clean = store.read(spark, "silver", "clean_events", partitions=True)
    if days is None:
        store.write(bitmaps.number_users(clean).withColumn("seq", F.lit(commit.seq).cast("long")), "silver", "user_numbers")
        store.write(bitmaps.user_bitmaps(clean, store.read(spark, "silver", "user_numbers")), "gold", "user_bitmaps")
        return
    own = clean.filter(on_periods("event_day", days))
    known = store.read(spark, "silver", "user_numbers", partitions=True).filter(F.col("seq") < commit.seq).select("user_id", "number")
    store.add_part(bitmaps.number_users(own, known), "silver", "user_numbers", commit.seq)
    store.replace_days(bitmaps.user_bitmaps(own, store.read(spark, "silver", "user_numbers")), "gold", "user_bitmaps", days)


# ---------------------------------------------------------------- the customers' states

def refresh_customers(spark: SparkSession, store: TierStore, commit: Commit) -> DataFrame:
    """Bring ``gold.customer_state`` up to the last finished refinement and return it.

    A state that holds the last full refinement takes in the changes since; any other is rebuilt.  The
    table is replaced as a whole, its ``through`` column with it, so no change is ever taken twice."""
    state = store.read(spark, "gold", "customer_state")
    row = state.select("through").limit(1).collect()
    through = row[0]["through"] if row else 0
    clean, orders = store.read(spark, "silver", "clean_events", partitions=True), store.read(spark, "silver", "validate_orders")
    if not commit.full or through < commit.full:
        state = gold.customer_state(clean, orders)
    elif through < commit.seq:
        changes = store.read(spark, "silver", "user_changes", partitions=True).filter(
            (F.col("seq") > through) & (F.col("seq") <= commit.seq))
        state = gold.merge_changes(state.drop("through"), changes.drop("seq"), clean)
    else:
        return state.drop("through")
    store.write(state.withColumn("through", F.lit(commit.seq).cast("long")), "gold", "customer_state")
    if commit.full:
        store.drop_parts(spark, "silver", "user_changes",
                         [n for n in store.parts(spark, "silver", "user_changes") if n <= commit.seq])
    return store.read(spark, "gold", "customer_state").drop("through")
