"""The reports as SQL table functions: equal to the DataFrame form, pruned alike, and strict."""

import pytest

from tierline.operators import gold, reports, silver, sql_functions
from tierline.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
AS_OF = fx.FIXTURE_AS_OF


@pytest.fixture(scope="module")
def tiers(spark):
    clean = silver.clean_events(fx.bronze_events(spark, SF), AS_OF).cache()
    raw = fx.bronze_orders(spark, SF).cache()
    orders = silver.validate_orders(raw, AS_OF).cache()
    tables = {"clean_events": clean, "bronze_orders": raw, "validate_orders": orders, "daily_kpis": gold.daily_kpis(clean).cache(),
              "customer_360": gold.customer_360(clean, orders, AS_OF).cache()}
    assert sql_functions.register(spark, tables) == [f"report_{n}" for n in sql_functions.SHAPES]
    return tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equal_to_the_reports(spark, tiers):
    call = lambda text: rows(spark.sql(f"SELECT * FROM {text}"))
    span = "DATE '2023-12-01', DATE '2024-01-20'"
    kpis = tiers["daily_kpis"]
    assert call(f"report_dau({span})") == rows(reports.report_dau(kpis, "2023-12-01", "2024-01-20"))
    assert call(f"report_funnel({span})") == rows(reports.report_funnel(tiers["clean_events"], "2023-12-01", "2024-01-20"))
    assert call("report_segments()") == rows(reports.report_user_segments(tiers["customer_360"]))
    for n in (1, 7, 100):
        assert call(f"report_top_products({n})") == rows(reports.report_top_products(tiers["validate_orders"], tiers["bronze_orders"], n))
    assert len(call("report_top_products()")) == 10  # the default
    for metric in sql_functions._METRICS:
        assert call(f"report_anomaly('{metric}', DATE '{AS_OF}', 45)") == rows(reports.report_anomaly(kpis, metric, 45, AS_OF))
    assert call(f"report_anomaly('dau', DATE '{AS_OF}')") == rows(reports.report_anomaly(kpis, "dau", 30, AS_OF))


def test_they_join_like_tables(spark, tiers):
    got = spark.sql("SELECT a.event_date FROM report_dau(DATE '2024-01-01', DATE '2024-01-10') a JOIN "
                    "report_dau(DATE '2024-01-05', DATE '2024-01-20') b ON a.event_date = b.event_date ORDER BY 1").collect()
    assert str(got[0].event_date) == "2024-01-05" and str(got[-1].event_date) == "2024-01-10"


@pytest.mark.parametrize("call, message", [
    ("report_top_products(0)", "n must be"), ("report_top_products(101)", "n must be"), ("report_top_products(NULL)", "n must be"),
    ("report_dau(NULL, DATE '2024-01-01')", "required"), ("report_funnel(DATE '2024-01-01', NULL)", "required"),
    (f"report_anomaly('latency', DATE '{AS_OF}', 30)", "unknown metric"), (f"report_anomaly('dau', DATE '{AS_OF}', 366)", "lookback"),
    ("report_anomaly('dau', NULL, 30)", "as_of")])
def test_bad_parameters_raise(spark, tiers, call, message):
    with pytest.raises(Exception, match=message):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_top_products_is_top_k(spark, tiers):
    plan = spark.sql("SELECT * FROM report_top_products(5)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan


def test_only_functions_whose_tables_are_there(spark, tiers):
    made = sql_functions.register(spark, {"daily_kpis": tiers["daily_kpis"]}, "only_")
    assert made == ["only_dau", "only_anomaly"]
