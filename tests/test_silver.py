from decimal import Decimal

from helpers import bronze_events, bronze_orders, ev, item, items, od

from tierline.operators import silver
from conftest import AS_OF


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedup_latest_wins_and_null_ids_dropped(spark):
    df = bronze_events(spark, [
        ev("e1", when="2024-01-01 10:00:00", page="/old"),
        ev("e1", when="2024-01-01 10:00:01", page="/new"),
        ev(None, when="2024-01-02 10:00:00"),
        ev("e2", when="2024-01-03 10:00:00"),
    ])
    out = silver.dedup_latest_events(df)
    assert rows(out, "event_id", "page") == [("e1", "/new"), ("e2", "/home")]


def test_dedup_ties_are_deterministic(spark):
    df = bronze_events(spark, [
        ev("e1", page="/b"), ev("e1", page="/a"), ev("e1", page="/c"),
    ])
    for _ in range(3):
        assert rows(silver.dedup_latest_events(df.repartition(3)), "page") == [("/a",)]


def test_null_timestamp_loses_to_any_time(spark):
    df = bronze_events(spark, [ev("e1", page="/t")])
    df = df.unionByName(spark.createDataFrame([("e1", "click", "u1", "s", "/null", None, "{}", None)],
                                              df.schema))
    assert rows(silver.dedup_latest_events(df), "page") == [("/t",)]


def test_enum_filter_runs_after_dedup(spark):
    df = bronze_events(spark, [
        ev("e1", event_type="click", when="2024-01-01 10:00:00"),
        ev("e1", event_type="hover", when="2024-01-01 10:00:05"),
        ev("e2", event_type="purchase"),
    ])
    out = silver.clean_events(df, AS_OF)
    assert rows(out, "event_id") == [("e2",)]


def test_clean_events_columns_key_and_metadata(spark):
    df = bronze_events(spark, [ev("e1", metadata="not json"), ev("e2", metadata='{"x": 2.50}'),
                               ev("e3", metadata="")])
    out = silver.clean_events(df, AS_OF)
    assert out.columns == ["event_key", "event_id", "user_id", "session_id", "event_type", "page", "referrer",
                           "event_timestamp", "metadata_json", "ingested_at"]
    got = {r.event_id: (r.event_key, r.metadata_json) for r in out.collect()}
    assert got["e1"][1] is None and got["e3"][1] is None
    assert got["e2"][1] == '{"x": 2.50}'  # original text kept
    import hashlib
    assert got["e1"][0] == hashlib.md5(b"e1").hexdigest()


def test_item_totals_edge_cases(spark):
    df = bronze_orders(spark, [
        od("o_ok", items(item(qty=2, price=29.99), item(qty=1, price=89.99)), 149.97),
        od("o_empty", "[]", 10.0),
        od("o_object", item(), 10.0),
        od("o_bad", "not json", 10.0),
        od("o_null", None, 10.0),
        od("o_partial", items(item(qty=2, price=5.0), '{"product_id": "x", "quantity": "abc", "unit_price": 3}'),
           10.0),
        od("o_text_num", items('{"quantity": "2", "unit_price": "1.005"}'), 2.02),
        od("o_round", items('{"quantity": 2.5, "unit_price": 2}'), 6.0),
    ])
    totals = dict(rows(silver.order_item_totals(df), "order_id", "calculated_total"))
    assert totals["o_ok"] == Decimal("149.97")
    assert totals["o_partial"] == Decimal("10.00")  # NULL product skipped, as SUM does
    assert totals["o_text_num"] == Decimal("2.02")  # "1.005" → 1.01 (half up), × 2
    assert totals["o_round"] == Decimal("6.00")  # quantity "2.5" rounds to 3 like a SQL cast
    for missing in ("o_empty", "o_object", "o_bad", "o_null"):
        assert missing not in totals
    grouped = dict(rows(silver.item_totals_grouped(df), "order_id", "calculated_total"))
    assert grouped == totals


def test_validation_tolerance_and_status(spark):
    df = bronze_orders(spark, [
        od("a", items(item(qty=1, price=10.00)), 10.01, status="confirmed"),
        od("b", items(item(qty=1, price=59.98)), 59.99, status="confirmed"),
        od("c", "[]", 25.0, status="pending"),
        od("d", item(), 10.0, status="pending"),
        od("e", items(item(qty=1, price=10.00)), 10.0, status=None),
    ])
    out = {r.order_id: r for r in silver.validate_orders(df, AS_OF).collect()}
    assert out["a"].status == "confirmed"
    assert out["b"].status == "validation_failed"
    assert out["c"].status == "validation_failed" and out["c"].validated_total == Decimal("0.00")
    assert out["d"].status == "validation_failed"
    assert out["e"].status is None  # a NULL status passes through unchanged
    assert out["a"].total_amount == Decimal("10.01")


def test_orders_dedup_latest_created_at(spark):
    df = bronze_orders(spark, [
        od("o1", items(item(price=1.0)), 1.0, when="2024-01-01 00:00:00", status="pending"),
        od("o1", items(item(price=1.0)), 1.0, when="2024-01-01 00:00:01", status="shipped"),
    ])
    assert rows(silver.validate_orders(df, AS_OF), "order_id", "status") == [("o1", "shipped")]


def test_explode_items_positions(spark):
    df = bronze_orders(spark, [od("o1", items(item("p1"), item("p2", qty=3)), 40.0)])
    got = rows(silver.order_items_exploded(df), "item_pos", "product_id", "quantity")
    assert got == [(0, "p1", 1), (1, "p2", 3)]
