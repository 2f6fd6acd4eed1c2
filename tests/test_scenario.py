"""Two shops' days, end to end, with results worked out by hand.

Monday 4 March 2024: Ada looks at three pages, clicks and buys; Ben looks at one page.
Tuesday 5 March: Ada looks at two pages; Cem signs up and meets an error.
Orders: Ada's two (one right, one whose total is off by a euro), Ben's one right order that was
delivered twice, and Dee's, whose items are no JSON array.  Dee has no event.
"""

import datetime as dt
from decimal import Decimal

import pytest

from helpers import bronze_events, bronze_orders, ev, item, items, od
from tierline.operators import envelopes, gold, reports, silver

AS_OF = "2024-03-12"
MONDAY, TUESDAY = dt.date(2024, 3, 4), dt.date(2024, 3, 5)


@pytest.fixture(scope="module")
def tiers(spark):
    mon, tue = "2024-03-04 09:{:02d}:00", "2024-03-05 18:{:02d}:00"
    events = [ev(f"a{i}", "page_view", "ada", mon.format(i)) for i in range(3)]
    events += [ev("a3", "click", "ada", mon.format(10)), ev("a4", "purchase", "ada", mon.format(20)),
               ev("b0", "page_view", "ben", mon.format(30)),
               ev("a5", "page_view", "ada", tue.format(0)), ev("a6", "page_view", "ada", tue.format(1)),
               ev("c0", "signup", "cem", tue.format(2)), ev("c1", "error", "cem", tue.format(3)),
               ev("c1", "error", "cem", tue.format(4)), ev("x", "dance", "cem", tue.format(5))]
    tea, pot = item("tea", "Green tea", 3, 4.5), item("pot", "Pot", 1, 30.0)
    orders = [od("o1", items(tea, pot), 43.5, "ada", "confirmed"), od("o2", items(pot), 31.0, "ada", "confirmed"),
              od("o3", items(tea), 13.5, "ben", "shipped", when="2024-01-30 10:00:00"),
              od("o3", items(tea), 13.5, "ben", "shipped", when="2024-01-30 10:00:09"),
              od("o4", tea, 13.5, "dee", "pending")]
    raw = bronze_orders(spark, orders)
    clean = silver.clean_events(bronze_events(spark, events), AS_OF)
    valid = silver.validate_orders(raw, AS_OF)
    return raw, clean, valid, gold.daily_kpis(clean), gold.customer_360(clean, valid, AS_OF)


def test_refined_and_aggregate_rows(tiers):
    _, clean, valid, kpis, profile = tiers
    assert clean.count() == 10
    assert {r.order_id: r.status for r in valid.collect()} == {
        "o1": "confirmed", "o2": "validation_failed", "o3": "shipped", "o4": "validation_failed"}
    got = {(r.event_date, r.event_type): (r.daily_active_users, r.total_events, r.conversion_rate) for r in kpis.collect()}
    assert got == {(MONDAY, "page_view"): (2, 4, 0.25), (MONDAY, "click"): (1, 1, 0.25), (MONDAY, "purchase"): (1, 1, 0.25),
                   (TUESDAY, "page_view"): (1, 2, 0.0), (TUESDAY, "signup"): (1, 1, 0.0), (TUESDAY, "error"): (1, 1, 0.0)}
    rows = {r.user_id: r for r in profile.collect()}
    ada, dee = rows["ada"], rows["dee"]
    assert (ada.total_orders, ada.valid_orders, ada.total_spend, ada.avg_order_value) == (2, 1, Decimal("43.50"), 43.5)
    assert (ada.days_since_last_activity, ada.most_common_event_type, ada.total_events) == (7, "page_view", 7)
    assert (dee.total_orders, dee.valid_orders, dee.last_seen, dee.total_events) == (1, 0, None, None)
    assert rows["cem"].most_common_event_type == "error"  # one each: the first by name


def test_reports(tiers):
    raw, clean, valid, kpis, profile = tiers
    dau = [tuple(r) for r in reports.report_dau(kpis, MONDAY, TUESDAY).collect()]
    assert dau == [(MONDAY, 4, 6, 0.25), (TUESDAY, 3, 4, 0.0)]
    top = [tuple(r) for r in reports.report_top_products(valid, raw, 5).collect()]
    assert top == [("tea", "Green tea", 40.5, 2), ("pot", "Pot", 30.0, 1)]  # both deliveries of o3 count
    once = [tuple(r) for r in reports.report_top_products(valid, raw, 5, dedupe_items=True).collect()]
    assert once == [("pot", "Pot", 30.0, 1), ("tea", "Green tea", 27.0, 2)]
    segments = {r.segment_name: r.user_count for r in reports.report_user_segments(profile).collect()}
    assert segments == {"Recent": 3, "Dormant": 1}
    funnel = [tuple(r) for r in reports.report_funnel(clean, MONDAY, MONDAY).collect()]
    assert funnel == [("page_view", 2, 4), ("click", 1, 1), ("purchase", 1, 1)]
    odd = reports.report_anomaly(kpis, "events", 30, AS_OF).collect()
    assert [(r.value, r.is_anomaly) for r in odd] == [(6.0, False), (4.0, False)]
    env = envelopes.envelope_dau(reports.report_dau(kpis, MONDAY, TUESDAY), MONDAY, TUESDAY)
    flat = envelopes.flat(env, "data").collect()
    assert [(r.place, r.active_users, r.total_active_users) for r in flat] == [(0, 4, 7), (1, 3, 7)]


def test_envelope_puts_a_product_without_revenue_last(tiers, spark):
    report = spark.createDataFrame([("p", "P", None, 1), ("q", "Q", 1.0, 1), ("r", "R", 5.0, 1)],
                                   "product_id string, product_name string, total_revenue double, order_count long")
    env = envelopes.envelope_top_products(report).collect()[0]
    assert [r.product_id for r in env.products] == ["r", "q", "p"]
