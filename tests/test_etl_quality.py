import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderlake.operators import etl as E
from orderlake.operators import quality as Q
from orderlake.schemas import ORDER_DOCUMENT, RAW_CUSTOMERS, RAW_ORDER_PAYMENTS
from tests.conftest import rows

T = dt.datetime


def test_dedup_orders_and_customers(spark):
    o = spark.createDataFrame([
        ("o1", "c1", "shipped", T(2020, 1, 1, 2)), ("o1", "c1", "shipped", T(2020, 1, 1, 1)),
        (None, "c2", "shipped", T(2020, 1, 1)), ("o2", None, "delivered", T(2020, 1, 2)),
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz")
    got = rows(E.dedup_orders(o), ["order_id"])
    assert [(r["order_id"], r["order_purchase_timestamp"]) for r in got] == \
        [("o1", T(2020, 1, 1, 1)), ("o2", T(2020, 1, 2))]
    c = spark.createDataFrame([
        ("c1", "u1", None, "b", "SP"), ("c1", "u1", None, "a", "SP"), ("c2", None, None, "x", "RJ"),
    ], RAW_CUSTOMERS)
    got = rows(E.dedup_customers(c))
    assert [(r["customer_id"], r["customer_city"]) for r in got] == [("c1", "a")]


def test_quality_checks_warn_only(spark):
    o = spark.createDataFrame([("o1", None, "delivered"), ("o2", "c2", "delivered"), (None, "c3", "delivered")],
                              "order_id string, customer_id string, order_status string")
    p = spark.createDataFrame([("o1", 1, "x", Decimal("0.00")), ("o1", 2, "x", None),
                               ("o9", 1, "x", Decimal("-1.00"))], RAW_ORDER_PAYMENTS)
    got = {r["check_name"]: (r["n_rows"], r["passed"]) for r in rows(Q.data_quality(o, p))}
    assert got == {"orders_without_customer": (1, False), "payments_not_positive": (2, False),
                   "delivered_without_payment": (2, False)}


def _docs(spark):
    item = lambda p, s, price, fr: {"product_id": p, "seller_id": s, "price": price, "freight_value": fr}
    base = dict(customer_id="c", customer_unique_id="u", customer_city="x", customer_state="SP",
                order_status="shipped", purchased_at=T(2026, 1, 1), estimated_delivery_at=None,
                payment_type="boleto", payment_value=10.0)
    docs = [
        dict(base, order_id="ok", items=[item("p", "s", 1.0, 0.0)]),
        dict(base, order_id="empty", items=[], order_status=None),
        dict(base, order_id="price0", items=[item("p", "s", 0.0, 0.0)]),
        dict(base, order_id="freight", items=[item("p", "s", 1.0, -1.0)]),
        dict(base, order_id="pay0", items=[], payment_value=0.0),
        dict(base, order_id="nostate", items=[], customer_state=None),
    ]
    return spark.createDataFrame(docs, ORDER_DOCUMENT)


def test_validate_documents(spark):
    valid, rejected = Q.validate_orders(_docs(spark))
    v = {r["order_id"]: r for r in rows(valid)}
    assert set(v) == {"ok", "empty"} and v["empty"]["order_status"] == "processing"
    rj = {r["order_id"]: r["reasons"] for r in rows(rejected)}
    assert rj == {"price0": ["item_price_not_positive"], "freight": ["item_freight_negative"],
                  "pay0": ["payment_value_not_positive"], "nostate": ["missing_customer_state"]}


def test_flat_validation_agrees_with_nested(spark):
    docs = _docs(spark)
    headers = docs.drop("items")
    items = docs.select("order_id", F.explode("items").alias("i")).select("order_id", "i.*")
    flat = {r["order_id"]: r["reasons"] for r in rows(Q.validate_order_rows(headers, items))}
    valid, rejected = Q.validate_orders(docs)
    nested = {r["order_id"]: r["reasons"] for r in rows(rejected)}
    nested.update({r["order_id"]: [] for r in rows(valid)})
    assert flat == nested
