import datetime as dt
from decimal import Decimal

from orderlake.operators import clean as C
from orderlake.schemas import (RAW_CATEGORY_TRANSLATION, RAW_ORDER_ITEMS, RAW_ORDER_PAYMENTS,
                               RAW_ORDER_REVIEWS, RAW_ORDERS, RAW_PRODUCTS)
from tests.conftest import rows

T = dt.datetime


def test_delivery_days_and_on_time(spark):
    df = spark.createDataFrame([
        ("o1", "c1", "delivered", T(2020, 1, 1, 2), None, None, T(2020, 1, 3, 1), T(2020, 1, 3, 1)),
        ("o2", "c2", "delivered", T(2020, 1, 3, 1), None, None, T(2020, 1, 1, 2), T(2020, 1, 10)),
        # delivered on the estimated day, one second late
        ("o3", "c3", "delivered", T(2020, 1, 1), None, None, T(2020, 1, 20, 0, 0, 1), T(2020, 1, 20)),
        ("o4", "c4", "processing", T(2020, 1, 1), None, None, None, T(2020, 1, 20)),
        (None, "c5", "delivered", T(2020, 1, 1), None, None, None, None),
    ], RAW_ORDERS)
    out = {r["order_id"]: r for r in rows(C.clean_orders(df))}
    assert set(out) == {"o1", "o2", "o3", "o4"}
    assert out["o1"]["delivery_days"] == 1 and out["o1"]["delivered_on_time"] == 1
    assert out["o2"]["delivery_days"] == -1
    assert out["o3"]["delivered_on_time"] == 0
    assert out["o4"]["delivery_days"] is None and out["o4"]["delivered_on_time"] == 0


def test_payments_types_sorted_distinct_and_null(spark):
    df = spark.createDataFrame([
        ("o1", 1, "voucher", Decimal("10.00")), ("o1", 2, "credit_card", Decimal("5.00")),
        ("o1", 3, "voucher", Decimal("1.00")), ("o2", 1, None, Decimal("3.00")),
        ("o3", 1, "boleto", Decimal("0.00")), (None, 1, "boleto", Decimal("1.00")),
    ], RAW_ORDER_PAYMENTS)
    out = {r["order_id"]: r for r in rows(C.clean_payments(df))}
    assert set(out) == {"o1", "o2"}
    assert out["o1"]["payment_types"] == "credit_card, voucher"
    assert out["o1"]["payment_installments_count"] == 3
    assert out["o1"]["total_payment"] == Decimal("16.00")
    assert out["o2"]["payment_types"] is None


def test_reviews_scores_comments_sentiment(spark):
    df = spark.createDataFrame([
        ("r0", "o", 0, None, "x", None, None), ("r1", "o", 1, None, None, None, None),
        ("r3", "o", 3, None, "   ", None, None), ("r4", "o", 4, "t", 'say "hi"\nbye', None, None),
        ("r5", "o", 5, None, "", None, None), ("r6", "o", 6, None, "x", None, None),
        ("rn", "o", None, None, "x", None, None),
    ], RAW_ORDER_REVIEWS)
    out = {r["review_id"]: r for r in rows(C.clean_reviews(df))}
    assert set(out) == {"r1", "r3", "r4", "r5"}
    assert [out[k]["sentiment"] for k in ("r1", "r3", "r4", "r5")] == ["negative", "neutral", "positive", "positive"]
    assert [out[k]["has_comment"] for k in ("r1", "r3", "r4", "r5")] == [0, 0, 1, 0]
    assert out["r1"]["review_message"] == "" and out["r1"]["review_title"] == ""


def test_items_and_products_categories(spark):
    items = spark.createDataFrame([
        ("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.50")),
        ("o1", 2, "p2", "s1", Decimal("5.00"), Decimal("0.00")),
        ("o1", 3, "p9", "s1", Decimal("5.00"), Decimal("0.00")),      # no product match
        ("o2", 1, "p3", "s2", Decimal("0.00"), Decimal("1.00")),      # price 0 dropped
    ], RAW_ORDER_ITEMS)
    products = spark.createDataFrame([
        ("p1", "cama", 100.0, 10.0, 2.0, 3.0, None), ("p2", "livros", 1.0, None, 2.0, 3.0, 2),
        ("p3", None, 1.0, 1.0, 1.0, 1.0, 1),
    ], RAW_PRODUCTS)
    tr = spark.createDataFrame([("cama", "bed")], RAW_CATEGORY_TRANSLATION)
    it = {r["order_item_id"]: r for r in rows(C.clean_order_items(items, products, tr))}
    assert set(it) == {1, 2, 3}
    assert it[1]["category_english"] == "bed" and it[1]["total_item_value"] == Decimal("11.50")
    assert it[2]["category_english"] == "livros"          # untranslated: original kept
    assert it[3]["category_english"] is None               # no product: stays NULL
    pr = {r["product_id"]: r for r in rows(C.clean_products(products, tr))}
    assert pr["p3"]["category"] == "unknown" and pr["p2"]["volume_cm3"] is None
    assert pr["p1"]["volume_cm3"] == 60.0 and pr["p1"]["photos_count"] == 0
