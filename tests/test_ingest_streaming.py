import datetime as dt
import uuid

from pyspark.sql import functions as F

from orderlake.operators.ingest import fan_out_orders, order_summary
from orderlake.session import checkpoint_dir
from orderlake.sources import months as MO
from orderlake.streaming import jobs as ST
from orderlake.streaming import refresh as RF
from orderlake.streaming import status as SS
from tests.test_etl_quality import _docs


def _tmp(spark):
    return f"{checkpoint_dir(spark)}/test-{uuid.uuid4().hex}"


def test_fan_out_numbering_and_nulls(spark):
    docs = _docs(spark)
    out = fan_out_orders(docs)
    assert {r["order_item_id"] for r in out["raw_order_items"].collect()} == {1}
    o = out["raw_orders"].filter("order_id = 'ok'").first()
    assert o["order_approved_at"] is None and o["order_delivered_customer_date"] is None
    assert out["raw_order_payments"].filter("payment_sequential <> 1").count() == 0
    s = {r["order_id"]: r["total_items"] for r in order_summary(docs).collect()}
    assert s["ok"] == 1 and s["empty"] == 0


def test_ingest_survives_a_lost_checkpoint(spark):
    root = _tmp(spark)
    _docs(spark).repartition(2).write.json(f"{root}/src")
    for i in range(2):   # the second run has a new checkpoint and reads both files in one batch
        q = ST.start_order_ingest(spark, f"{root}/src", f"{root}/sink", f"{root}/ck-{uuid.uuid4().hex}",
                                  max_files_per_trigger=1 if i == 0 else None)
        q.awaitTermination()
    for name, n in (("raw_orders", 2), ("raw_customers", 2), ("raw_order_payments", 2), ("rejects", 4)):
        assert ST.read_ingested(spark, f"{root}/sink", name).count() == n
    # a batch that wrote tables but no marker is not seen
    spark.read.parquet(f"{root}/sink/raw_orders").limit(1).drop("run", "batch_id").withColumn("order_id", F.lit("half")) \
        .write.parquet(f"{root}/sink/raw_orders/run=x/batch_id=0")
    assert ST.read_ingested(spark, f"{root}/sink", "raw_orders").count() == 2


def test_a_status_moves_once(spark):
    root, T = _tmp(spark), dt.datetime
    docs = _docs(spark).filter("order_id = 'ok'").withColumn("order_status", F.lit("processing")) \
        .withColumn("purchased_at", F.lit(T(2026, 2, 1, 12)).cast("timestamp")).withColumn("estimated_delivery_at", F.lit(T(2026, 2, 20)).cast("timestamp"))
    docs.write.json(f"{root}/src")
    ST.start_order_ingest(spark, f"{root}/src", f"{root}/sink", f"{root}/ck").awaitTermination()
    seen = []
    for as_of in (T(2026, 2, 1, 12, 20), T(2026, 2, 1, 13), T(2026, 2, 2, 13)):
        SS.advance_ingested(spark, f"{root}/sink", f"{root}/st", as_of)
        r = SS.read_status(spark, f"{root}/st", f"{root}/sink").first()
        seen.append((r["order_status"], r["order_delivered_carrier_date"], r["shipped_now"]))
    assert seen == [("shipped", T(2026, 2, 1, 12, 20), True), ("delivered", T(2026, 2, 1, 12, 20), False), ("delivered", T(2026, 2, 1, 12, 20), False)]


def test_windowed_revenue_drops_late_rows(spark):
    root = _tmp(spark)
    T = dt.datetime
    schema = "ts timestamp_ntz, value double, id long"
    spark.createDataFrame([(T(2024, 1, 1, 1), 1.0, 1), (T(2024, 1, 3, 1), 2.0, 2)], schema) \
        .write.parquet(f"{root}/in/b0")
    # arrives later: Jan 1 is now more than a day behind the watermark → dropped
    spark.createDataFrame([(T(2024, 1, 1, 2), 5.0, 3), (T(2024, 1, 3, 2), 4.0, 4), (T(2024, 1, 3, 2), 4.0, 4)],
                          schema).write.parquet(f"{root}/in/b1")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    ST.run_to_parquet(ST.daily_revenue_stream(src, "ts", "value"), f"{root}/out", f"{root}/ck", "update")
    got = {r["window_start"].day: (r["revenue"], r["n_rows"])
           for r in ST.latest_per_key(spark.read.parquet(f"{root}/out"), ["window_start", "window_end"]).collect()}
    assert got[3] == (10.0, 3)
    src2 = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    ST.run_to_parquet(ST.dedup_stream(src2, "id", "ts"), f"{root}/dedup", f"{root}/ck2")
    ids = sorted(r["id"] for r in spark.read.parquet(f"{root}/dedup").collect())
    assert ids.count(4) == 1 and 2 in ids


def test_refresh_touched_months(spark):
    """An order without a purchase time, and a month whose last delivered order is canceled."""
    from orderlake.operators import metrics as A
    root = _tmp(spark)
    T = dt.datetime

    def orders(rows):
        return spark.createDataFrame([(*r, 1, 3) for r in rows], "order_id string, order_status string, purchased_at timestamp_ntz, "
                                     "delivered_on_time int, delivery_days int")

    first = orders([("o1", "delivered", T(2020, 1, 5)), ("o2", "delivered", T(2020, 2, 5))])
    then = orders([("o1", "canceled", T(2020, 1, 5)), ("o2", "delivered", T(2020, 2, 5)), ("o3", "delivered", None), ("o4", "delivered", T(2020, 3, 1))])
    p = spark.createDataFrame([(f"o{i}", float(i)) for i in range(1, 5)], "order_id string, total_payment double") \
        .withColumn("total_payment", F.col("total_payment").cast("decimal(18,2)")) \
        .withColumn("payment_installments_count", F.lit(1)).withColumn("payment_types", F.lit("x"))
    reviews = spark.createDataFrame([("o2", 5, 1)], "order_id string, review_score int, has_comment int")
    RF.refresh_reports(spark, root, RF.store_batch(spark, root, RF.order_facts(first, p, reviews)))
    files = _files(spark, f"{root}/daily_revenue/data/month=2020-02-01") | _files(spark, f"{root}/facts/data/month=2020-02-01")
    RF.refresh_reports(spark, root, RF.store_batch(spark, root, RF.order_facts(then.filter("order_id <> 'o2'"), p, reviews)))
    got = RF.read_reports(spark, root, 1)
    want = {"daily_revenue": A.daily_revenue(then, p), "monthly_revenue": A.monthly_revenue(then, p, 1),
            "kpi_summary": A.kpi_summary(then, p, reviews), "payment_analysis": A.payment_analysis(then, p)}
    for name, df in want.items():
        assert sorted(map(str, got[name].select(df.columns).collect())) == sorted(map(str, df.collect())), name
    # the untouched month kept its files
    assert files == _files(spark, f"{root}/daily_revenue/data/month=2020-02-01") | _files(spark, f"{root}/facts/data/month=2020-02-01")


def _files(spark, folder):
    from orderlake.sources.files import _fs
    fs, path = _fs(spark, folder)
    found = fs.listFiles(path, True)
    out = {}
    while found.hasNext():
        f = found.next()
        out[f.getPath().toString()] = f.getModificationTime()
    return set(out.items())


def _days(spark, rows):
    return spark.createDataFrame(rows, "id int, day date, v int").withColumn("month", F.trunc("day", "MM"))


def test_month_tables_read_and_write_the_wanted_months_alone(spark):
    root, D = _tmp(spark), dt.date
    rows = [(1, D(2020, 1, 3), 1), (2, D(2020, 2, 3), 1), (3, None, 1), (4, D(2020, 3, 1), 1)]
    df = _days(spark, rows)
    MO.replace_months(df, root, "t", MO.months_of(df), "a")
    one = MO.read_months(spark, root, "t", months=[D(2020, 2, 1)])
    assert [r["id"] for r in one.collect()] == [2] and all("month=2020-02-01" in f for f in one.inputFiles())
    assert [r["id"] for r in MO.read_months(spark, root, "t", months=[None]).collect()] == [3]
    reader = MO.read_months(spark, root, "t")
    # January becomes empty, March gets another row; February is not touched
    new = _days(spark, [(5, D(2020, 3, 2), 2)])
    MO.replace_months(new, root, "t", [D(2020, 1, 1), D(2020, 3, 1)], "b")
    assert sorted(r["id"] for r in MO.read_months(spark, root, "t").collect()) == [2, 3, 5]
    assert MO.read_months(spark, root, "t", months=[D(2020, 1, 1)]).count() == 0
    # a version without a commit is not seen, and writing it again replaces it
    new.withColumn("version", F.lit("c")).write.partitionBy("month", "version").parquet(f"{root}/t/data", mode="append")
    assert sorted(r["id"] for r in MO.read_months(spark, root, "t").collect()) == [2, 3, 5]
    # a reader from before keeps its rows until the replaced versions are removed
    assert sorted(r["id"] for r in reader.collect()) == [1, 2, 3, 4]
    assert MO.remove_replaced(spark, root, "t", keep_since="b") == ["month=2020-01-01/version=a", "month=2020-03-01/version=a"]
    assert sorted(r["id"] for r in MO.read_months(spark, root, "t").collect()) == [2, 3, 5]


def _orders(spark, ids, day, status="delivered", pay=2.0):
    schema = ("order_id string, order_status string, purchased_at timestamp_ntz, delivered_on_time int, delivery_days int, total_payment double, "
              "payment_installments_count int, payment_types string, n_reviews bigint, score_sum bigint, score_n bigint, comment_sum bigint")
    rows = [(i, status, day, 1, 3, pay, 2, "x", 2, 9, 2, 1) for i in ids]
    return spark.createDataFrame(rows, schema).withColumn("total_payment", F.col("total_payment").cast("decimal(18,2)")) \
        .withColumn("month", F.trunc(F.to_date("purchased_at"), "MM"))


def test_states_add_up_over_repeated_and_overlapping_batches(spark):
    root, T = _tmp(spark), dt.datetime
    first = _orders(spark, ["a", "b", "b"], T(2020, 1, 5)).unionByName(_orders(spark, ["n"], None)).unionByName(_orders(spark, ["p"], T(2020, 1, 5), pay=None))
    second = _orders(spark, ["b", "c"], T(2020, 1, 5), pay=4.0).unionByName(_orders(spark, ["d"], T(2020, 1, 6), status="canceled"))
    RF.add_batch(spark, root, first, 0)
    RF.add_batch(spark, root, first, 0)          # the same batch again
    RF.add_batch(spark, root, second, 1)
    RF.add_batch(spark, root, second, 1)
    RF.add_batch(spark, root, second, 2)         # the same orders in a further batch
    got = RF.state_reports(spark, root, 1)
    days = {r["order_date"]: (r["total_orders"], r["revenue"], r["avg_order_value"]) for r in got["daily_revenue"].collect()}
    assert days == {dt.date(2020, 1, 5): (3, 8.0, 2.67), None: (1, 2.0, 2.0)}
    kpi = {r["month"]: r for r in got["kpi_summary"].collect()}[dt.date(2020, 1, 1)]
    assert (kpi["total_orders"], kpi["avg_basket"], kpi["cancellation_rate_pct"], kpi["avg_review_score"]) == (4, 2.5, 25.0, 4.5)
    # a batch without its commit marker does not count
    numbers = spark.read.option("basePath", f"{root}/numbers").parquet(f"{root}/numbers/batch_id=0").drop("batch_id")
    numbers.withColumn("order_id", F.lit("z")).write.partitionBy("month").parquet(f"{root}/numbers/batch_id=9")
    RF.add_batch(spark, root, _orders(spark, ["z"], T(2020, 1, 5)), 3)
    assert {r["order_date"]: r["total_orders"] for r in RF.state_reports(spark, root, 1)["daily_revenue"].collect()}[dt.date(2020, 1, 5)] == 4


def test_more_orders_a_day_than_a_bitmap_holds(spark):
    root = _tmp(spark)
    many = _orders(spark, ["x"], dt.datetime(2020, 1, 5)).drop("order_id").crossJoin(spark.range(40_000).select(F.concat(F.lit("o"), "id").alias("order_id")))
    RF.add_batch(spark, root, many.filter("order_id < 'o3'"), 0)
    RF.add_batch(spark, root, many, 1)
    r = RF.state_reports(spark, root, 1)["daily_revenue"].first()
    assert (r["total_orders"], r["revenue"]) == (40_000, 80_000.0)


def test_a_cycle_writes_open_and_closing_orders_alone(spark):
    root, T = _tmp(spark), dt.datetime
    one = _docs(spark).filter("order_id = 'ok'").withColumn("estimated_delivery_at", F.lit(T(2026, 2, 20)).cast("timestamp"))

    def docs(ids, status, at):
        names = spark.createDataFrame([(i,) for i in ids], "order_id string")
        return one.drop("order_id").crossJoin(names).withColumn("order_status", F.lit(status)).withColumn("purchased_at", F.lit(at).cast("timestamp")) \
            .withColumn("customer_id", F.col("order_id"))

    def ingest(*frames):
        for f in frames:
            f.write.mode("append").json(f"{root}/src")
        ST.start_order_ingest(spark, f"{root}/src", f"{root}/sink", f"{root}/ck").awaitTermination()

    def state():
        return {r["order_id"]: r["order_status"] for r in SS.read_status(spark, f"{root}/st", f"{root}/sink").collect()}

    old = [f"c{i}" for i in range(50)]
    ingest(docs(old, "canceled", T(2026, 1, 5)), docs(["p"], "processing", T(2026, 2, 1, 12)))
    SS.advance_ingested(spark, f"{root}/sink", f"{root}/st", T(2026, 2, 1, 12, 5))
    assert state() == {**{i: "canceled" for i in old}, "p": "processing"}
    before = _files(spark, f"{root}/st/closed/cycle=0")
    # the next cycle: one new order, and old ones that come again
    ingest(docs(["q", *old[:3]], "processing", T(2026, 1, 5)))
    cycle = SS.advance_ingested(spark, f"{root}/sink", f"{root}/st", T(2026, 2, 1, 12, 20))
    assert state() == {**{i: "canceled" for i in old}, "p": "shipped", "q": "delivered"}
    assert before == _files(spark, f"{root}/st/closed/cycle=0")
    written = [spark.read.parquet(f"{root}/st/{part}/cycle={cycle}").count() for part in ("open", "closed")]
    assert written == [1, 1]
    # a cycle that died before its marker is overwritten
    from orderlake.sources.files import _fs
    fs, marker = _fs(spark, f"{root}/st/cycles/cycle={cycle}")
    fs.delete(marker, True)
    assert state() == {**{i: "canceled" for i in old}, "p": "processing"}
    assert SS.advance_ingested(spark, f"{root}/sink", f"{root}/st", T(2026, 2, 1, 12, 20)) == cycle
    want = {**{i: "canceled" for i in old}, "p": "shipped", "q": "delivered"}
    assert state() == want
    for _ in range(2):
        SS.compact(spark, f"{root}/st")
        assert state() == want
    SS.advance_ingested(spark, f"{root}/sink", f"{root}/st", T(2026, 2, 1, 13))
    assert state() == {**want, "p": "delivered"}


def test_rejects_are_all_kept_and_valid_copies_win(spark):
    root = _tmp(spark)
    ok = _docs(spark).filter("order_id = 'ok'")
    bad = ok.withColumn("payment_value", F.lit(-1.0))
    nameless = ok.withColumn("order_id", F.lit(None).cast("string"))
    later = ok.withColumn("purchased_at", F.col("purchased_at") + F.expr("INTERVAL 1 DAY"))
    bad.unionByName(later).unionByName(nameless).unionByName(nameless).unionByName(ok).unionByName(bad).coalesce(1).write.json(f"{root}/src")
    for _ in range(2):
        ST.start_order_ingest(spark, f"{root}/src", f"{root}/sink", f"{root}/ck-{uuid.uuid4().hex}").awaitTermination()
    rejects = [r["order_id"] for r in ST.read_ingested(spark, f"{root}/sink", "rejects").collect()]
    assert sorted(map(str, rejects)) == ["None", "None", "ok", "ok"]
    kept = ST.read_ingested(spark, f"{root}/sink", "raw_orders").collect()
    assert [r["order_purchase_timestamp"] for r in kept] == [r["purchased_at"] for r in ok.select(F.col("purchased_at").cast("timestamp_ntz").alias("purchased_at")).collect()]
    assert spark.read.parquet(f"{root}/sink/commits").agg(F.sum("n_documents")).first()[0] == 12


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_moves_documents_once_at_most(spark):
    """no order text in the shuffle of repeated orders, and no shuffle to read the rows of one batch."""
    plan = _plan(ST.one_per_order(_docs(spark).drop("reasons")))
    assert plan.count("Exchange") == 1 and "to_json" not in plan[plan.index("Exchange"):]
    root = _tmp(spark)
    late = _docs(spark).filter("order_id = 'ok'").withColumn("purchased_at", F.expr("purchased_at + INTERVAL 1 DAY"))
    bad = late.withColumn("payment_value", F.lit(-1.0))
    late.unionByName(late).unionByName(_docs(spark)).unionByName(bad).unionByName(bad).repartition(3).write.json(f"{root}/src")
    ST.start_order_ingest(spark, f"{root}/src", f"{root}/sink", f"{root}/ck").awaitTermination()
    for name, n in (("raw_orders", 2), ("raw_customers", 2), ("raw_order_payments", 2), ("rejects", 6)):
        rows = ST.read_ingested(spark, f"{root}/sink", name)
        assert rows.count() == n and "Exchange hash" not in _plan(rows), name
    first = _docs(spark).filter("order_id = 'ok'").first()["purchased_at"]
    kept = ST.read_ingested(spark, f"{root}/sink", "raw_orders").filter("order_id = 'ok'").first()["order_purchase_timestamp"]
    assert kept.replace(tzinfo=None) == first.replace(tzinfo=None)


def test_ingest_and_its_readers_hold_bounded_shares_in_memory(spark, monkeypatch):
    """no task keeps its share of a batch in memory, and the documents decide in how many parts the keys are hashed."""
    root, plans = _tmp(spark), []
    fan_out = ST.fan_out_orders
    monkeypatch.setattr(ST, "fan_out_orders", lambda valid: plans.append(_plan(valid)) or fan_out(valid))
    docs = _docs(spark)
    docs.repartition(2).write.json(f"{root}/src")
    for _ in range(2):
        ST.start_order_ingest(spark, f"{root}/src", f"{root}/sink", f"{root}/ck-{uuid.uuid4().hex}").awaitTermination()
    assert len(plans) == 2 and all("InMemoryTableScan" not in p and "FileScan parquet" in p for p in plans)
    assert not [f for f, _ in _files(spark, f"{root}/sink") if "/parsed/" in f]
    monkeypatch.setattr(ST, "KEYS_A_TASK", 1)
    n = 2 * docs.count()
    assert n > spark.sparkContext.defaultParallelism and str(n) != spark.conf.get("spark.sql.shuffle.partitions")
    for name in ("raw_orders", "raw_customers", "raw_order_payments"):
        rows = ST.read_ingested(spark, f"{root}/sink", name)
        plan = _plan(rows)
        assert rows.count() == 2 and plan.count("Exchange hash") == plan.count(f", {n}), REPARTITION_BY_NUM") == 2, plan


def test_add_batch_computes_the_batch_once(spark):
    """what the batch comes from is not run again for its months, its sampled bounds and its numbers."""
    made = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    facts = spark.range(40).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.lit("delivered").alias("order_status"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 05:00:00' + make_dt_interval(cast(id as int))").alias("purchased_at"), F.lit(1).alias("delivered_on_time"),
        F.lit(3).alias("delivery_days"), F.col("id").cast("decimal(18,2)").alias("total_payment"), F.lit(1).cast("bigint").alias("payment_installments_count"),
        F.lit("x").alias("payment_types"), *[F.lit(1).cast("bigint").alias(c) for c in ("n_reviews", "score_sum", "score_n", "comment_sum")])
    facts = facts.withColumn("month", F.trunc("purchased_at", "month"))
    for i in range(2):
        RF.add_batch(spark, f"{_tmp(spark)}", facts.mapInArrow(told, facts.schema), i)
    assert made.value == 80
