import datetime as dt

import pytest
from helpers import bronze_events, bronze_orders, ev, item, items, od

from conftest import AS_OF
from tierline.operators import gold, reports, silver, sql_reports


@pytest.fixture()
def views(spark):
    ce = silver.clean_events(bronze_events(spark, [
        ev(str(i), ["page_view", "click", "purchase", "signup"][i % 4], f"u{i % 7}",
           "2024-01-%02d 1%d:00:00" % (1 + i % 28, i % 10)) for i in range(200)
    ]), AS_OF)
    raw = bronze_orders(spark, [
        od(f"o{i}", items(item(f"p{i % 5}", qty=1 + i % 3, price=10.0 + i % 4)), (1 + i % 3) * (10.0 + i % 4),
           user=f"u{i % 9}") for i in range(40)
    ])
    vo = silver.validate_orders(raw, AS_OF)
    kpis = gold.daily_kpis(ce)
    c360 = gold.customer_360(ce, vo, AS_OF)
    tables = {"clean_events": ce, "validate_orders": vo, "bronze_orders": raw, "daily_kpis": kpis,
              "customer_360": c360}
    return ce, vo, raw, kpis, c360, tables


def same(a, b):
    assert a.columns == b.columns
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]


def test_sql_forms_equal_dataframe_forms(spark, views):
    ce, vo, raw, kpis, c360, t = views
    same(sql_reports.report(spark, "dau", t, date_from="2024-01-03", date_to=dt.date(2024, 1, 20)),
         reports.report_dau(kpis, "2024-01-03", "2024-01-20"))
    same(sql_reports.report(spark, "top_products", t, n=3), reports.report_top_products(vo, raw, 3))
    same(sql_reports.report(spark, "segments", t), reports.report_user_segments(c360))
    same(sql_reports.report(spark, "funnel", t, date_from="2024-01-05", date_to="2024-01-09"),
         reports.report_funnel(ce, "2024-01-05", "2024-01-09"))
    for metric in ("dau", "conversion", "events", "total_events"):
        same(sql_reports.report(spark, "anomaly", t, metric=metric, lookback_days=20, as_of=AS_OF),
             reports.report_anomaly(kpis, metric, 20, AS_OF))


def test_sql_reports_reject_unknown_names(spark, views):
    t = views[-1]
    with pytest.raises(ValueError):
        sql_reports.report(spark, "anomaly", t, metric="1); DROP TABLE x; --", as_of=AS_OF)
    with pytest.raises(ValueError):
        sql_reports.report(spark, "nope", t)
    with pytest.raises(ValueError):
        sql_reports.report(spark, "segments", {**t, "other": spark.range(1)})


def test_bound_parameters_are_values_not_text(spark, views):
    t = views[-1]
    # a date parameter holding SQL text is bound as a value; parsing it as a date fails
    with pytest.raises(Exception):
        sql_reports.report(spark, "dau", t, date_from="2024-01-01' OR '1'='1", date_to="2024-01-02")
    assert sql_reports.report(spark, "top_products", t, n=1).count() == 1
    # nothing is left registered in the session catalog
    assert not [x for x in spark.catalog.listTables() if x.name in sql_reports.VIEWS]
