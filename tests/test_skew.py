"""Hot keys: one event id redelivered many times, one user holding a third of all rows."""

from helpers import bronze_events, bronze_orders, ev

from conftest import AS_OF
from tierline.operators import gold, silver


def test_hot_keys_give_whole_results(spark):
    n = 3000
    rows = [ev("hot", "click", "u_hot", "2024-01-10 00:00:%02d" % (i % 60), page=f"/p{i}") for i in range(n)]
    rows += [ev(f"e{i}", ["click", "purchase", "page_view"][i % 3], "u_hot" if i % 3 == 0 else f"u{i % 50}",
                "2024-01-%02d 10:00:00" % (1 + i % 28)) for i in range(2 * n)]
    df = bronze_events(spark, rows).repartition(8)
    clean = silver.clean_events(df, AS_OF)
    assert clean.count() == 2 * n + 1
    hot = clean.filter("event_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0].event_timestamp.second == 59  # latest copy wins
    no_orders = silver.validate_orders(bronze_orders(spark, []), AS_OF)
    c = {r.user_id: r for r in gold.customer_360(clean, no_orders, AS_OF).collect()}
    assert c["u_hot"].total_events == 1 + len([i for i in range(2 * n) if i % 3 == 0])
    k = gold.daily_kpis(clean).collect()
    assert sum(r.total_events for r in k) == 2 * n + 1
