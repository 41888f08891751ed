import datetime as dt
from decimal import Decimal

from orderlake.functions.numeric import round_double
from orderlake.operators import clean as C
from orderlake.operators import metrics as A
from orderlake.schemas import RAW_ORDER_PAYMENTS, RAW_ORDER_REVIEWS, RAW_ORDERS, RAW_CUSTOMERS
from tests.conftest import rows

T = dt.datetime


def _fixture(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", T(2020, 1, 5), None, None, T(2020, 1, 9), T(2020, 1, 20)),
        ("o2", "c2", "delivered", T(2020, 1, 6), None, None, T(2020, 1, 30), T(2020, 1, 20)),
        ("o3", "c3", "canceled", T(2020, 1, 7), None, None, None, T(2020, 1, 20)),
        ("o4", "c1", "delivered", T(2020, 3, 1), None, None, T(2020, 3, 3), T(2020, 3, 20)),
        ("o5", "c4", "delivered", T(2020, 1, 8), None, None, T(2020, 1, 9), T(2020, 1, 20)),  # no payment
    ], RAW_ORDERS)
    pays = spark.createDataFrame([
        ("o1", 1, "credit_card", Decimal("1.00")), ("o2", 1, "voucher", Decimal("1.01")),
        ("o3", 1, "boleto", Decimal("50.00")), ("o4", 1, "boleto", Decimal("300.00")),
    ], RAW_ORDER_PAYMENTS)
    reviews = spark.createDataFrame([      # o1: two reviews, o2: one, others none
        ("r1", "o1", 5, None, "great", None, None), ("r2", "o1", 3, None, None, None, None),
        ("r3", "o2", 1, None, "bad", None, None),
    ], RAW_ORDER_REVIEWS)
    customers = spark.createDataFrame([
        ("c1", "u1", "01037", "city_a", "SP"), ("c2", "u2", None, "city_b", "RJ"),
        ("c3", "u3", None, "city_c", "RJ"), ("c4", "u1", None, "city_z", "SP"),
    ], RAW_CUSTOMERS)
    return (C.clean_orders(orders), C.clean_payments(pays), C.clean_reviews(reviews),
            C.clean_customers(customers))


def _plain_sql(spark, o, p, r):
    o.createOrReplaceTempView("t_o"), p.createOrReplaceTempView("t_p"), r.createOrReplaceTempView("t_r")
    return spark.sql("""
        SELECT avg(p.total_payment) AS basket, avg(o.delivered_on_time) * 100 AS ontime,
               avg(o.delivery_days) AS days, avg(r.review_score) AS score, avg(r.has_comment) * 100 AS cmt,
               count(*) AS n
        FROM t_o o JOIN t_p p ON o.order_id = p.order_id LEFT JOIN t_r r ON o.order_id = r.order_id""").first()


def test_weighted_review_join_equals_row_join(spark):
    o, p, r, _ = _fixture(spark)
    got = {x["month"]: x for x in rows(A.kpi_summary(o, p, r))}
    jan = got[dt.date(2020, 1, 1)]
    plain = _plain_sql(spark, o.filter("month(purchased_at) = 1"), p, r)
    assert jan["avg_basket"] == float(round(Decimal(str(plain.basket)), 2))
    assert jan["on_time_delivery_rate_pct"] == round(plain.ontime, 2)
    assert jan["avg_review_score"] == round(plain.score, 2)
    assert jan["review_comment_rate_pct"] == round(plain.cmt, 2)
    # one canceled row among the four joined rows (o1 twice, o2, o3)
    assert jan["cancellation_rate_pct"] == 25.0
    per_order = {x["month"]: x for x in rows(A.kpi_summary(o, p, r, review_weight="per_order"))}
    assert per_order[dt.date(2020, 1, 1)]["cancellation_rate_pct"] == round(100 / 3, 2)


def test_half_up_rounding_of_cents(spark):
    o, p, r, _ = _fixture(spark)
    # o1 (1.00) and o2 (1.01) on different days; their monthly mean is 1.005 → 1.01
    rev = {x["month"]: x for x in rows(A.monthly_revenue(o, p, min_orders=1))}
    assert rev[dt.date(2020, 1, 1)]["avg_order_value"] == 1.01
    df = spark.createDataFrame([(1.005,), (2.675,)], "x double")
    assert [x[0] for x in df.select(round_double("x", 2)).collect()] == [1.01, 2.68]


def test_monthly_growth_skips_dropped_month(spark):
    o, p, r, _ = _fixture(spark)
    rev = {x["month"]: x for x in rows(A.monthly_revenue(o, p, min_orders=1))}
    assert rev[dt.date(2020, 1, 1)]["revenue_growth_pct"] is None
    # March follows January directly (February has no order): (300 - 2.01) / 2.01 * 100
    assert rev[dt.date(2020, 3, 1)]["revenue_growth_pct"] == round((300 - 2.01) / 2.01 * 100, 2)
    only_big = rows(A.monthly_revenue(o, p, min_orders=2))
    assert [x["month"] for x in only_big] == [dt.date(2020, 1, 1)]


def test_clv_grain_and_cohorts(spark):
    o, p, r, c = _fixture(spark)
    clv = rows(A.customer_lifetime_value(c, o, p), ["customer_unique_id", "city"])
    # u1 bought in two cities: two rows (o5 has no payment, so city_z drops out)
    assert [(x["customer_unique_id"], x["city"], x["total_orders"]) for x in clv] == \
        [("u1", "city_a", 2), ("u2", "city_b", 1)]
    assert clv[0]["customer_lifespan_days"] == 56 and clv[0]["customer_segment"] == "mid_value"
    coh = {(x["cohort_month"], x["months_since_first_order"]): x["active_customers"]
           for x in rows(A.cohort_retention(c, o))}
    assert coh == {(dt.date(2020, 1, 1), 0): 2, (dt.date(2020, 1, 1), 2): 1}


def test_top_categories_without_copies_of_the_items(spark):
    """both distinct counts from rows that stay with their order; null orders, products and prices as before."""
    items = spark.createDataFrame([("o1", "p1", Decimal("1.00"), "a"), ("o1", "p1", Decimal("1.01"), "a"), ("o1", "p2", None, "a"), ("o2", "p1", Decimal("3.00"), "a"),
                                   (None, None, Decimal("5.00"), "a"), ("o1", "p3", None, None), ("o3", None, Decimal("2.00"), "b")],
                                  "order_id string, product_id string, price decimal(18,2), category_english string")
    got = A.top_categories(items)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["category"]: (r["total_orders"], r["total_revenue"], r["avg_price"], r["unique_products"]) for r in rows(got)} == {
        "a": (2, 10.01, 2.5, 2), None: (1, None, None, 1), "b": (1, 2.0, 2.0, 0)}
