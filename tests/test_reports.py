import datetime as dt

from orderlake.operators import reports as RP
from tests.conftest import rows


def test_spending_bands_right_closed(spark):
    clv = spark.createDataFrame([(x,) for x in (0.0, 0.01, 100.0, 100.01, 1000.0, 1000.5)], "total_spent double")
    got = {r["spending_range"]: r["count"] for r in rows(RP.spending_bands(clv))}
    assert got == {"0-100 R$": 2, "100-200 R$": 1, "200-500 R$": 0, "500-1000 R$": 1, "1000+ R$": 1}


def test_recent_orders_nulls_first_and_ties(spark):
    T = dt.datetime
    df = spark.createDataFrame([("o3", "c", "x", T(2020, 1, 2)), ("o1", "c", "x", T(2020, 1, 2)),
                                ("o2", "c", "x", None), ("o4", "c", "x", T(2020, 1, 1))],
                               "order_id string, customer_id string, order_status string, "
                               "order_purchase_timestamp timestamp_ntz")
    assert [r["order_id"] for r in RP.recent_orders(df, 3).collect()] == ["o2", "o1", "o3"]


def test_repeat_rate_and_seller_rows(spark):
    clv = spark.createDataFrame([(1,), (2,), (3,), (1,)], "total_orders long")
    assert rows(RP.repeat_rate(clv))[0]["repeat_rate_pct"] == 50.0
    empty = spark.createDataFrame([], "total_orders long")
    assert rows(RP.repeat_rate(empty))[0]["repeat_rate_pct"] == 0.0
    sellers = spark.createDataFrame(
        [("s2", 10.0, 4.0, 50.0, 1, 3.0), ("s1", 10.0, None, 100.0, 1, 2.0), ("s3", 5.0, 5.0, None, 1, 1.0)],
        "seller_id string, total_revenue double, avg_review_score double, on_time_rate_pct double, "
        "total_orders long, avg_delivery_days double")
    assert [(r["rank"], r["seller_id"]) for r in rows(RP.seller_list(sellers), ["rank"])] == \
        [(1, "s1"), (2, "s2"), (3, "s3")]
    ov = rows(RP.seller_overview(sellers))[0]
    assert ov == {"n_sellers": 3, "mean_review_score": 4.5, "mean_on_time_rate_pct": 75.0}
