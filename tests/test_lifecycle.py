import datetime as dt

from orderlake.operators import lifecycle as L
from orderlake.schemas import RAW_ORDERS
from tests.conftest import rows

NOW = dt.datetime(2026, 3, 1, 12, 0, 0)


def _orders(spark):
    m = dt.timedelta(minutes=1)
    est = NOW + dt.timedelta(days=10)
    return spark.createDataFrame([
        ("young", "c", "processing", NOW - 14 * m - dt.timedelta(seconds=59), None, None, None, est),
        ("at15", "c", "processing", NOW - 15 * m, None, None, None, est),
        ("at45", "c", "processing", NOW - 45 * m, None, None, None, est),
        ("ship44", "c", "shipped", NOW - 44 * m, None, None, None, est),
        ("old", "c", "processing", dt.datetime(2025, 12, 31), None, None, None, est),
        ("done", "c", "delivered", NOW - 60 * m, None, None, NOW, est),
    ], RAW_ORDERS)


def test_thresholds_and_floor(spark):
    got = {r["order_id"]: r for r in rows(L.advance_status(_orders(spark), NOW))}
    assert got["young"]["order_status"] == "processing"
    assert got["at15"]["order_status"] == "shipped" and got["at15"]["order_delivered_carrier_date"] == NOW
    assert got["at45"]["order_status"] == "delivered" and got["at45"]["shipped_now"]
    assert got["ship44"]["order_status"] == "shipped" and not got["ship44"]["delivered_now"]
    assert got["old"]["order_status"] == "processing"        # before the floor date
    assert got["done"]["order_delivered_customer_date"] == NOW and not got["done"]["delivered_now"]
    d = got["at45"]["order_delivered_customer_date"]
    lead = dt.timedelta(days=10, minutes=45)
    assert NOW - dt.timedelta(minutes=45) + 0.65 * lead <= d <= NOW - dt.timedelta(minutes=45) + 1.16 * lead
    summary = rows(L.status_summary(L.advance_status(_orders(spark), NOW)))[0]
    assert summary == {"shipped": 2, "delivered": 1}


def test_replay_is_stable(spark):
    once = L.advance_status(_orders(spark), NOW).drop("shipped_now", "delivered_now")
    twice = L.advance_status(once, NOW).drop("shipped_now", "delivered_now")
    assert rows(once, ["order_id"]) == rows(twice, ["order_id"])
