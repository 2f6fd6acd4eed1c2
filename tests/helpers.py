from datetime import datetime

from tierline import schemas


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def bronze_events(spark, rows):
    """rows: tuples in BRONZE_EVENTS order."""
    return spark.createDataFrame(rows, schemas.BRONZE_EVENTS)


def bronze_orders(spark, rows):
    return spark.createDataFrame(rows, schemas.BRONZE_ORDERS)


def ev(event_id, event_type="page_view", user="u1", when="2024-01-30 10:00:00", metadata='{"a": 1}',
       page="/home", session="s1", referrer=None):
    return (event_id, event_type, user, session, page, referrer, metadata, ts(when))


def od(order_id, items, total, user="u1", status="pending", when="2024-01-30 10:00:00", currency="USD",
       address=None):
    return (order_id, user, items, total, currency, status, address, ts(when))


def item(pid="p1", name="Widget", qty=1, price=10.0):
    return ('{"product_id": "%s", "product_name": "%s", "quantity": %s, "unit_price": %s}'
            % (pid, name, qty, price))


def items(*elems):
    return "[" + ", ".join(elems) + "]"
