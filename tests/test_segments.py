import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from orderlake.operators import segments as M
from orderlake.session import checkpoint_dir
from orderlake.sources.files import read_table
from orderlake.schemas import RAW_CUSTOMERS, RAW_ORDER_PAYMENTS, RAW_ORDERS
from tests.conftest import rows

T = dt.datetime


def test_rfm_features_rules(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", T(2020, 1, 10, 23), None, None, None, None),
        ("o2", "c2", "delivered", T(2020, 1, 1, 1), None, None, None, None),
        ("o3", "c2", "delivered", T(2020, 1, 5), None, None, None, None),
        ("o4", "c3", "shipped", T(2020, 1, 9), None, None, None, None),     # not delivered
    ], RAW_ORDERS)
    pays = spark.createDataFrame([("o1", 1, "x", Decimal("10.00")), ("o2", 1, "x", Decimal("0.00")),
                                  ("o3", 1, "x", Decimal("5.00")), ("o4", 1, "x", Decimal("7.00"))],
                                 RAW_ORDER_PAYMENTS)
    cust = spark.createDataFrame([("c1", "u1", None, "a", "SP"), ("c2", "u2", None, "b", "RJ"),
                                  ("c3", "u3", None, "c", "RJ")], RAW_CUSTOMERS)
    got = {r["customer_unique_id"]: r for r in rows(M.rfm_features(cust, orders, pays))}
    assert set(got) == {"u1", "u2"}
    assert got["u1"]["recency"] == 0 and got["u2"]["recency"] == 5      # calendar days to Jan 10
    assert got["u2"]["frequency"] == 2 and got["u2"]["monetary"] == 5.0  # the 0 payment is kept


def test_labels_average_ranks_on_ties(spark):
    # medians per cluster: recency 10/10/30/5, frequency 1/2/1/1, monetary 100/50/50/200
    data = []
    for cluster, r, f, m in [(0, 10, 1, 100.0), (1, 10, 2, 50.0), (2, 30, 1, 50.0), (3, 5, 1, 200.0)]:
        data += [(f"u{cluster}{i}", r, f, m, cluster) for i in range(3)]
    df = spark.createDataFrame(data, "customer_unique_id string, recency int, frequency long, "
                                     "monetary double, cluster int")
    lab = {r["cluster"]: r for r in rows(M.label_clusters(df))}
    # pandas average ranks: recency [2.5, 2.5, 4, 1], frequency [2, 4, 2, 2], monetary [3, 1.5, 1.5, 4]
    assert [lab[c]["score"] for c in range(4)] == [2.5, 3.0, -0.5, 5.0]
    assert [lab[c]["segment"] for c in range(4)] == ["A risque", "Clients fidèles", "Inactifs", "Champions"]


def test_sample_is_the_smallest_hashes(spark):
    df = spark.range(20000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("customer_unique_id"),
                                   F.col("id").alias("v"))
    fast = [r["customer_unique_id"] for r in M.sample_customers(df, 50, 7).collect()]
    key = F.md5(F.concat(F.lit("7:"), F.col("customer_unique_id")))
    naive = [r["customer_unique_id"] for r in df.orderBy(key, "customer_unique_id").limit(50).collect()]
    assert sorted(fast) == sorted(naive) and len(fast) == 50
    some = df.limit(300).unionByName(spark.createDataFrame([(None, 1)], "customer_unique_id string, v long"))
    assert all(r["customer_unique_id"] for n in (20, 50, 299) for r in M.sample_customers(some, n).collect())
    assert M.sample_customers(some, 301).filter("customer_unique_id is null").count() == 1


def test_kmeans_segmentation_smoke(spark):
    from orderlake.sources import testdata
    r = testdata.raw_tables(spark, "/root/testdata/sf0.001")
    rfm = M.rfm_features(r["raw_customers"], r["raw_orders"], r["raw_order_payments"])
    fit = M.fit_kmeans(rfm, n_init=2)
    segs = M.assign_segments(fit.assigned, M.label_clusters(fit.assigned))
    sizes = {r["segment"]: r["n_customers"] for r in rows(M.segment_sizes(segs))}
    assert set(sizes) <= set(M.SEGMENT_LABELS.values()) and sum(sizes.values()) == rfm.count()
    from pyspark.ml.evaluation import ClusteringEvaluator
    judged = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", distanceMeasure="squaredEuclidean").evaluate(fit.assigned)
    assert abs(M.silhouette(fit.assigned).first()[0] - judged) < 1e-9
    assert abs(M.inertia(fit).first()[0] - fit.cost) < 1e-6 * fit.cost
    assert M.squared_distances(fit).filter("own > nearest + 1e-9").count() == 0
    root = f"{checkpoint_dir(spark)}/test-{uuid.uuid4().hex}"
    for _ in range(2):
        M.save_run(fit, segs, root)
    assert read_table(spark, root, "customer_segments").count() == segs.count()
    metrics = spark.read.parquet(f"{root}/run_metrics")
    assert metrics.select("run").distinct().count() == 2
    assert {r["metric"] for r in metrics.collect()} >= {"n_clusters", "silhouette_squared_euclidean", "inertia", "n_customers"}
    pca = M.pca_projection(M.cap_outliers(M.sample_customers(segs, 100)))
    assert pca.count() == 100 and {"pc1", "pc2", "pc1_variance_pct"} <= set(pca.columns)


def test_kmeans_keeps_its_own_points(spark, monkeypatch):
    """The input is not persisted as table rows, which every iteration would decode again."""
    rows = spark.range(40).select(F.col("id").cast("string").alias("customer_unique_id"), (F.col("id") % 4).cast("int").alias("recency"),
                                  (F.col("id") % 5).alias("frequency"), F.col("id").cast("double").alias("monetary"))

    def refused(self, *a, **k):
        raise AssertionError("persisted")

    monkeypatch.setattr(type(rows), "persist", refused)
    fit = M.fit_kmeans(rows, n_init=2, max_iter=5)
    assert fit.assigned.count() == 40
