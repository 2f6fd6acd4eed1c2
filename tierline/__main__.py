"""Command line: run the ingest, the scheduled refresh, or a report over a tier store.

    python -m tierline ingest  --store PATH (--topics PATH | --kafka SERVERS) [--once] [--checkpoint PATH]
    python -m tierline refresh --store PATH --as-of YYYY-MM-DD [--topics PATH | --kafka SERVERS] [--steps ...]
    python -m tierline report  --store PATH dau --date-from D --date-to D
    python -m tierline report  --store PATH top-products [--n 10]
    python -m tierline report  --store PATH segments
    python -m tierline report  --store PATH funnel --date-from D --date-to D
    python -m tierline report  --store PATH anomalies [--metric dau] [--lookback 30] [--as-of D]

``report`` prints the report envelope as one JSON document (the rows the reference's HTTP API
returned); envelopes are bounded by their parameters, so printing one row is safe.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from tierline.operators import envelopes, reports
from tierline.plans.refresh import STEPS, run_refresh
from tierline.session import get_spark
from tierline.sources.tables import TierStore
from tierline.streaming import ingest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tierline")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    p.add_argument("--format", default="parquet", help="file or table format of the store")
    sub = p.add_subparsers(dest="command", required=True)

    ing = sub.add_parser("ingest")
    ing.add_argument("--store", required=True)
    ing.add_argument("--topics")
    ing.add_argument("--kafka")
    ing.add_argument("--checkpoint")
    ing.add_argument("--once", action="store_true", help="drain what is there (availableNow) and stop")
    ing.add_argument("--interval", default="1 minute")
    ing.add_argument("--max-offsets", type=int, default=ingest.MAX_OFFSETS_PER_TRIGGER)
    ing.add_argument("--max-bytes", type=int, default=ingest.MAX_FILE_BYTES_PER_TRIGGER)

    ref = sub.add_parser("refresh")
    ref.add_argument("--store", required=True)
    ref.add_argument("--as-of", required=True)
    ref.add_argument("--topics")
    ref.add_argument("--kafka")
    ref.add_argument("--checkpoint")
    ref.add_argument("--incremental", action="store_true", help="only what new batches touch")
    ref.add_argument("--steps", nargs="+", default=list(STEPS), choices=list(STEPS))

    rep = sub.add_parser("report")
    rep.add_argument("--store", required=True)
    rep.add_argument("name", choices=["dau", "top-products", "segments", "funnel", "anomalies"])
    rep.add_argument("--date-from")
    rep.add_argument("--date-to")
    rep.add_argument("--n", type=int, default=None)
    rep.add_argument("--metric", default=None)
    rep.add_argument("--lookback", type=int, default=None)
    rep.add_argument("--as-of", default=None)
    return p


def report_envelope(spark, store: TierStore, args) -> str:
    """The envelope of one report as a JSON document."""
    if args.name == "dau":
        d0, d1 = envelopes.check_date(args.date_from, "date_from"), envelopes.check_date(args.date_to, "date_to")
        env = envelopes.envelope_dau(reports.report_dau(store.read(spark, "gold", "daily_kpis"), d0, d1), d0, d1)
    elif args.name == "top-products":
        n = envelopes.check_top_n(args.n)
        env = envelopes.envelope_top_products(reports.report_top_products(
            store.read(spark, "silver", "validate_orders"), store.read(spark, "bronze", "orders"), n))
    elif args.name == "segments":
        env = envelopes.envelope_segments(reports.report_user_segments(store.read(spark, "gold", "customer_360")))
    elif args.name == "funnel":
        d0, d1 = envelopes.check_date(args.date_from, "date_from"), envelopes.check_date(args.date_to, "date_to")
        env = envelopes.envelope_funnel(reports.report_funnel(store.read(spark, "silver", "clean_events"), d0, d1),
                                        d0, d1)
    else:
        metric, lookback = envelopes.check_metric(args.metric), envelopes.check_lookback(args.lookback)
        as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
        env = envelopes.envelope_anomaly(
            reports.report_anomaly(store.read(spark, "gold", "daily_kpis"), metric, lookback, as_of), metric, lookback)
    return env.toJSON().first()


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_spark(args.master)
    store = TierStore(args.store, args.format)
    if args.command == "ingest":
        store.bootstrap(spark)
        source = (ingest.read_topics(spark, "kafka", bootstrap_servers=args.kafka,
                                     max_offsets_per_trigger=args.max_offsets) if args.kafka
                  else ingest.read_topics(spark, "files", args.topics, max_bytes_per_trigger=args.max_bytes))
        ingest.start_ingest(source, store, args.checkpoint, available_now=args.once,
                            interval=args.interval).awaitTermination()
    elif args.command == "refresh":
        res = run_refresh(spark, store, args.as_of, topic_path=args.topics, bootstrap_servers=args.kafka,
                          checkpoint=args.checkpoint, steps=tuple(args.steps), incremental=args.incremental)
        print("written:", ", ".join(res.written))
        if res.freshness is not None:
            for r in res.freshness.collect():  # one row per raw table
                print(f"freshness {r.source_name}: {r.status} (latest {r.latest_at})")
    else:
        print(report_envelope(spark, store, args))
    return 0


if __name__ == "__main__":
    sys.exit(main())
