import datetime as dt
from decimal import Decimal

from helpers import bronze_events, bronze_orders, ev, item, items, od

from conftest import AS_OF
from tierline.operators import gold, silver


def clean(spark, rows):
    return silver.clean_events(bronze_events(spark, rows), AS_OF)


def orders(spark, rows):
    return silver.validate_orders(bronze_orders(spark, rows), AS_OF)


def test_daily_kpis_conversion_and_counts(spark):
    df = clean(spark, [
        ev("1", "page_view", "u1", "2024-01-10 01:00:00"),
        ev("2", "page_view", "u2", "2024-01-10 02:00:00"),
        ev("3", "page_view", "u1", "2024-01-10 03:00:00"),
        ev("4", "purchase", "u1", "2024-01-10 04:00:00"),
        ev("5", "click", "u3", "2024-01-11 04:00:00"),  # a day without page views
    ])
    k = {(r.event_date, r.event_type): r for r in gold.daily_kpis(df).collect()}
    pv = k[(dt.date(2024, 1, 10), "page_view")]
    assert (pv.daily_active_users, pv.total_events) == (2, 3)
    assert pv.conversion_rate == round(1 / 3, 4)
    assert k[(dt.date(2024, 1, 10), "purchase")].conversion_rate == round(1 / 3, 4)
    assert k[(dt.date(2024, 1, 11), "click")].conversion_rate is None


def test_conversion_rounding_ties_half_up(spark):
    # 1 purchase / 8 page views = 0.125 exactly → 4 places keeps it; 1/16 = 0.0625.
    rows = [ev(str(i), "page_view", "u1", "2024-01-10 01:00:00") for i in range(16)]
    rows.append(ev("p", "purchase", "u1", "2024-01-10 02:00:00"))
    k = gold.daily_kpis(clean(spark, rows)).collect()
    assert {r.conversion_rate for r in k} == {0.0625}


def test_customer_360_profile(spark):
    ce = clean(spark, [
        ev("1", "click", "u1", "2024-01-20 10:00:00"),
        ev("2", "page_view", "u1", "2024-01-29 10:00:00"),
        ev("3", "click", "u2", "2024-01-01 10:00:00"),
        ev("4", "page_view", "u2", "2024-01-02 10:00:00"),
    ])
    vo = orders(spark, [
        od("o1", items(item(price=300.0)), 300.0, user="u1", status="confirmed"),
        od("o2", items(item(price=300.0)), 301.0, user="u1", status="confirmed"),  # fails validation
        od("o3", items(item(price=100.0)), 100.0, user="u3", status="shipped"),  # order-only user
    ])
    c = {r.user_id: r for r in gold.customer_360(ce, vo, AS_OF).collect()}
    u1 = c["u1"]
    assert (u1.total_orders, u1.valid_orders, u1.total_spend) == (2, 1, Decimal("300.00"))
    assert u1.avg_order_value == 300.0
    assert u1.days_since_last_activity == 2
    assert u1.total_events == 2 and u1.first_seen == dt.datetime(2024, 1, 20, 10)
    assert c["u2"].most_common_event_type == "click"  # tie → alphabetically first
    assert (c["u2"].total_orders, c["u2"].total_spend, c["u2"].avg_order_value) == (0, Decimal("0.00"), 0.0)
    u3 = c["u3"]
    assert u3.first_seen is None and u3.days_since_last_activity is None and u3.total_events is None
    assert u3.most_common_event_type is None and u3.valid_orders == 1


def test_customer_360_matches_reference_shape(spark):
    ce = clean(spark, [ev(str(i), t, f"u{i % 3}", "2024-01-1%d 10:00:00" % (i % 9))
                       for i, t in enumerate(["click", "purchase", "error", "signup", "page_view"] * 4)])
    vo = orders(spark, [od(f"o{i}", items(item(price=10.0 * i)), 10.0 * i, user=f"u{i % 5}") for i in range(1, 9)])
    fast = {r.user_id: r.asDict() for r in gold.customer_360(ce, vo, AS_OF).collect()}
    # Reference form: three aggregates, distinct union, three left joins.
    ev_ = gold.customer_events(ce).alias("e")
    tt = gold.top_event_type(ce).alias("t")
    co = gold.customer_orders(vo).alias("o")
    users = gold.all_users(ce, vo)
    ref = (users.join(ev_, "user_id", "left").join(tt, "user_id", "left").join(co, "user_id", "left")).collect()
    assert set(fast) == {r.user_id for r in ref}
    for r in ref:
        f = fast[r.user_id]
        assert f["first_seen"] == r.first_seen and f["last_seen"] == r.last_seen
        assert f["total_events"] == r.total_events
        assert f["most_common_event_type"] == r.event_type
        assert f["total_orders"] == (r.total_orders or 0) and f["valid_orders"] == (r.valid_orders or 0)
        assert f["total_spend"] == (r.total_spend if r.total_spend is not None else Decimal("0.00"))


def test_customer_360_null_user_gets_one_empty_row(spark):
    ce = clean(spark, [ev("1", "click", None), ev("2", "click", "u1")])
    vo = orders(spark, [od("o1", items(item(price=5.0)), 5.0, user=None)])
    out = [r for r in gold.customer_360(ce, vo, AS_OF).collect() if r.user_id is None]
    assert len(out) == 1
    r = out[0]
    assert r.first_seen is None and r.total_events is None and r.total_orders == 0 and r.total_spend == 0


def test_single_exchange_in_customer_360(spark):
    ce = clean(spark, [ev("1")])
    vo = orders(spark, [od("o1", items(item(price=5.0)), 5.0)])
    plan = gold.customer_360(ce, vo, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # dedup of each side (2) + the one user_id aggregate (1); no join exchanges
    assert plan.count("Exchange hashpartitioning") == 3, plan
