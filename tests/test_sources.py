import datetime as dt
import uuid

from pyspark.sql import functions as F

from orderlake.session import checkpoint_dir
from orderlake.sources import files as FS


def _tmp(spark):
    return f"{checkpoint_dir(spark)}/test-{uuid.uuid4().hex}"


def test_csv_raw_source_schema_quotes_newlines_and_missing(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "raw_order_reviews.csv").write_text(
        'review_id,order_id,review_score,review_comment_title,review_comment_message,'
        'review_creation_date,review_answer_timestamp\n'
        'r1,o1,5,,"he said ""wow""\nand left",2020-01-01 10:00:00+00,2020-01-02T11:00:00\n'
        'r2,o2,3,t,,2020-01-03 00:00:00,\n')
    (d / "raw_customers.csv").write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01037,sao paulo,SP\n")
    raw = FS.read_raw(spark, f"file://{d}")
    assert set(raw) == {"raw_order_reviews", "raw_customers"}          # absent files skipped
    rv = {r["review_id"]: r for r in raw["raw_order_reviews"].collect()}
    assert rv["r1"]["review_comment_message"] == 'he said "wow"\nand left'
    assert rv["r1"]["review_creation_date"] == dt.datetime(2020, 1, 1, 10)   # offset text dropped
    assert rv["r1"]["review_answer_timestamp"] == dt.datetime(2020, 1, 2, 11)
    assert rv["r2"]["review_comment_message"] is None and rv["r2"]["review_answer_timestamp"] is None
    assert raw["raw_customers"].first()["customer_zip_code_prefix"] == "01037"


def test_versioned_tables_and_catalog(spark):
    root = _tmp(spark)
    df1 = spark.range(3).withColumn("v", F.lit(1))
    p1 = FS.write_table(df1, root, "t")
    FS.publish_table(spark, "orderlake_test", "t", p1)
    assert spark.table("orderlake_test.t").count() == 3
    p2 = FS.write_table(spark.range(5).withColumn("v", F.lit(2)), root, "t")
    assert FS.latest_version(spark, root, "t") == p2 or FS.latest_version(spark, root, "t").endswith(p2.split(":")[-1])
    assert FS.read_table(spark, root, "t").count() == 5
    FS.publish_table(spark, "orderlake_test", "t", p2)
    assert spark.table("orderlake_test.t").count() == 5


def test_full_refresh_buckets_and_publishes(spark):
    from orderlake.operators import metrics as A
    from orderlake.plans.layers import run_full_refresh
    from orderlake.sources import testdata

    root = _tmp(spark)
    raw = testdata.raw_tables(spark, "/root/testdata/sf0.001")
    counts = {(r["layer"], r["table_name"]): r["n_rows"]
              for r in run_full_refresh(spark, raw, root, min_month_orders=1, publish=True,
                                    database_prefix="t_").collect()}
    assert counts[("clean", "orders")] == 1500 and counts[("quality", "checks")] == 3
    assert spark.table("t_analytics.daily_revenue").count() == counts[("analytics", "daily_revenue")]
    # the per-order clean tables are co-bucketed: joining them needs no shuffle on order_id
    plan = A.daily_revenue(spark.table("t_clean.orders"), spark.table("t_clean.payments"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" not in plan


def test_multi_line_records_split_over_many_tasks(spark):
    """Quotes and line breaks everywhere, cut into splits of a few hundred bytes, against Spark's one-task reader."""
    import random

    from orderlake.schemas import RAW_SCHEMAS
    from orderlake.sources.records import multi_line_records

    root, rnd = _tmp(spark), random.Random(3)
    pieces = ['a', 'b c', '""', '\n', ',', '\n\n', '""""', 'é', '\r\n', '  ']
    lines = ["review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"]
    for i in range(3000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12)))
        quoted = f'"{text}"' if text and i % 4 else ""
        lines.append(f"r{i},o{i},{i % 5 + 1},{'t' if i % 2 else quoted},{quoted},2020-01-01 10:00:00,")
    lines.insert(1500, 'big,o,1,,"' + "line\n" * 900 + '",,')   # longer than several splits
    for part, rows in enumerate((lines[:2000], lines[:1] + lines[2000:])):
        path = f"{root}/part-{part}.csv"
        fs, p = FS._fs(spark, path)
        out = fs.create(p)
        out.write(bytearray("\n".join(rows).encode()))
        out.close()
    schema = RAW_SCHEMAS["raw_order_reviews"]
    whole = spark.read.schema(FS._text_schema(schema)).option("header", True).option("multiLine", True).options(**FS.CSV_OPTIONS).csv(root)
    want = sorted(map(str, whole.select("review_id", "review_comment_title", "review_comment_message").collect()))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert multi_line_records(spark, root).select("value").count() == len(lines) + 1
        got = FS.read_csv_table(spark, root, schema, multi_line=True)
        assert got.count() == len(lines) - 1
        told = got.select("review_id", "review_comment_title", "review_comment_message").collect()
        assert spark.read.text(root).rdd.getNumPartitions() > 100
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(str, told)) == want


def test_a_quote_that_is_not_closed_is_refused(spark, tmp_path):
    import pytest

    from orderlake.sources.records import multi_line_records

    (tmp_path / "x.csv").write_text('a,b\n1,"x\n' + "y\n" * 200)
    assert multi_line_records(spark, f"file://{tmp_path}/x.csv").count() == 2
    with pytest.raises(Exception, match="over 100 characters"):
        multi_line_records(spark, f"file://{tmp_path}/x.csv", max_record=100).collect()


def test_bad_rows_are_quarantined(spark, tmp_path):
    (tmp_path / "raw_order_payments.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_value\n"
        "o1,1,boleto,10.50\no2,x,boleto,1.00\no3,1,boleto,ten\no4,,,\no5,1,boleto\no6,1,boleto,1.00,more\n\n")
    (tmp_path / "raw_order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\r\n"
        'r1,o1,5,,"two\nlines",2020-01-01 10:00:00+00,\r\n'
        'r2,o2,5,,"bad\ndate",2020-13-01 10:00:00,soon\r\n')
    tables, rejects = FS.load_raw(spark, f"file://{tmp_path}", _tmp(spark))
    assert set(tables) == {"raw_order_payments", "raw_order_reviews"}
    assert sorted((r["order_id"], r["payment_sequential"]) for r in tables["raw_order_payments"].collect()) == [("o1", 1), ("o4", None)]
    good = tables["raw_order_reviews"].collect()
    assert [(r["review_comment_message"], r["review_creation_date"]) for r in good] == [("two\nlines", dt.datetime(2020, 1, 1, 10))]
    bad = {r["record"]: [tuple(p) for p in r["problems"]] for r in rejects.collect()}
    assert bad == {
        "o2,x,boleto,1.00": [("payment_sequential", "x", "not a int")],
        "o3,1,boleto,ten": [("payment_value", "ten", "not a decimal(18,2)")],
        "o5,1,boleto": [(None, None, "field count")],
        "o6,1,boleto,1.00,more": [(None, None, "field count")],
        'r2,o2,5,,"bad\ndate",2020-13-01 10:00:00,soon': [
            ("review_creation_date", "2020-13-01 10:00:00", "not a timestamp_ntz"), ("review_answer_timestamp", "soon", "not a timestamp_ntz")]}


def test_versions_are_removed_unless_leased(spark):
    import pytest

    root = _tmp(spark)
    FS.write_bucketed_table(spark.range(4), root, "default", "r", "id", 2)
    ident = FS.write_bucketed_table(spark.range(5), root, "default", "r", "id", 2)
    assert len(FS.remove_old_versions(spark, root, "r", keep=1, database="default")) == 1
    assert [t.name for t in spark.catalog.listTables("default") if t.name.startswith("r__v")] == [ident.split("`")[3].lower()]
    assert spark.table(ident).count() == 5
    FS.write_table(spark.range(1), root, "t")
    path, lease = FS.lease_version(spark, root, "t")
    for n in (2, 3, 4):
        FS.write_table(spark.range(n), root, "t")
    assert len(FS.remove_old_versions(spark, root, "t", keep=2)) == 1 and spark.read.parquet(path).count() == 1
    FS.lease_version(spark, root, "t", seconds=-1)      # a lease that has ended
    FS.release(spark, lease)
    assert len(FS.remove_old_versions(spark, root, "t", keep=1)) == 2 and FS.read_table(spark, root, "t").count() == 4
    spark.range(9).write.parquet(f"{root}/t/v=99999999T000000000000/unfinished")   # a version that is still being written
    assert FS.remove_old_versions(spark, root, "t", keep=1) == [] and FS.read_table(spark, root, "t").count() == 4
    with pytest.raises(ValueError):
        FS.remove_old_versions(spark, root, "t", keep=0)


def test_product_report_copies_no_fact_for_a_distinct(spark):
    from orderlake.operators import metrics as A
    T = dt.datetime
    items = spark.createDataFrame([("o1", "p", "s1", 1.0, None), ("o1", "p", "s2", 2.0, None), ("o2", "p", None, 4.0, None), ("o2", "p", "s1", None, None), (None, "p", "s9", 8.0, None)],
                                  "order_id string, product_id string, seller_id string, price double, category_english string") \
        .withColumn("price", F.col("price").cast("decimal(18,2)"))
    orders = spark.createDataFrame([("o1", "delivered", T(2020, 1, 1)), ("o2", "delivered", T(2020, 1, 1))], "order_id string, order_status string, purchased_at timestamp_ntz")
    reviews = spark.createDataFrame([("o1", 5, 1), ("o1", 4, 0)], "order_id string, review_score int, has_comment int")
    got = A.top_products(items, orders, reviews)
    r = got.first()
    assert (r["total_orders"], r["seller_count"], r["total_revenue"], r["avg_price"], r["avg_review_score"]) == (2, 2, 10.0, 2.0, 4.5)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_csv_checks_count_cells_by_short_keys(spark):
    """distinct values of all columns are counted without a copy of the whole row for each column."""
    from orderlake.plans.catalog import QUERIES
    plan = QUERIES["s2_read_all_raw_csv"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
