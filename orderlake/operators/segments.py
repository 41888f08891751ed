"""Customer segmentation (M1–M13): RFM features, K-Means, labels, profiles, PCA view.

Features are computed and standardised with DataFrame aggregates; global
statistics (reference date, means, deviations, caps) are scalar subqueries,
evaluated once and shipped to tasks as literals. K-Means, the silhouette and
PCA are ``pyspark.ml`` estimators, so the fit is distributed; only the k
cluster centres and the 3x3 PCA model reach the driver. Exact per-cluster
medians use the distributed row numbering (``exact_median``).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.functions.numeric import round_double
from orderlake.operators.ranking import exact_medians
from orderlake.session import checkpoint_dir
from orderlake.sources.files import latest_version, read_table, write_table

FEATURES = ["recency", "frequency", "monetary"]

# Segment labels by score position (best first).
SEGMENT_LABELS = {1: "Champions", 2: "Clients fidèles", 3: "A risque", 4: "Inactifs"}


# ---------------------------------------------------------------- M1 / M2

def rfm_features(raw_customers: DataFrame, raw_orders: DataFrame, raw_order_payments: DataFrame) -> DataFrame:
    """M1: recency (days before the latest purchase overall), frequency, monetary per person.

    Delivered orders only; payments are summed per order without a sign filter.
    Rows with any NULL feature are dropped.
    """
    orders = raw_orders.filter(F.col("order_status") == "delivered") \
        .select("order_id", "customer_id", "order_purchase_timestamp")
    pay = raw_order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment"))
    j = orders.join(pay, "order_id").join(
        raw_customers.select("customer_id", "customer_unique_id"), "customer_id")
    per = j.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("_last"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("total_payment").alias("_monetary"),
    )
    ref = per.agg(F.max("_last")).scalar()
    return per.select(
        "customer_unique_id",
        F.datediff(F.to_date(ref), F.to_date("_last")).cast("int").alias("recency"),
        "frequency",
        F.col("_monetary").cast("double").alias("monetary"),
    ).dropna()


def standardize(df: DataFrame, cols: list[str] = FEATURES, suffix: str = "_z") -> DataFrame:
    """M2: (x - mean) / population std per column; a constant column becomes 0.

    All means and deviations come from one aggregate pass (a single
    struct-valued scalar subquery), then one projection applies them.
    """
    stats = df.agg(F.struct(*[e for c in cols for e in (
        F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}"))])).scalar()
    out = [F.col(c) for c in df.columns]
    for c in cols:
        mean, std = stats[f"m_{c}"], stats[f"s_{c}"]
        z = F.when(std == 0, F.lit(0.0)).otherwise((F.col(c).cast("double") - mean) / std)
        out.append(z.alias(c + suffix))
    return df.select(*out)


# ---------------------------------------------------------------- M3 – M5

@dataclass
class SegmentationFit:
    model: KMeansModel
    cost: float
    seed: int
    assigned: DataFrame          # features + ``cluster``


def fit_kmeans(rfm: DataFrame, k: int = 4, n_init: int = 10, seed: int = 42,
               max_iter: int = 300, tol: float = 1e-4, parallel_fits: int = 4) -> SegmentationFit:
    """M3: K-Means on standardised RFM; ``n_init`` seeded fits, lowest cost kept.

    The standardised features are checkpointed (a reliable copy: the fits and
    every report read it instead of recomputing the RFM lineage). The fit input
    keeps the partitions of that copy. It is not persisted here: K-Means then
    persists its own points while it iterates, instead of decoding table rows
    in every iteration (recomputable from the checkpoint if an executor is lost).
    """
    checkpoint_dir(rfm.sparkSession)
    z = standardize(rfm).checkpoint(eager=True)
    assembler = VectorAssembler(inputCols=[c + "_z" for c in FEATURES], outputCol="features")
    vec = assembler.transform(z).select("features")

    def fit_one(s: int) -> tuple[float, int, KMeansModel]:
        m = KMeans(k=k, seed=s, maxIter=max_iter, tol=tol, featuresCol="features",
                   predictionCol="cluster").fit(vec)
        return m.summary.trainingCost, s, m

    # The seeded restarts are independent jobs over the same input; submitting
    # a few at once lets the scheduler overlap them. Each fit depends only on
    # its seed, so the choice below is unchanged.
    with ThreadPoolExecutor(max_workers=max(1, min(n_init, parallel_fits))) as pool:
        fits = list(pool.map(fit_one, range(seed, seed + n_init)))
    best = min(fits, key=lambda t: (t[0], t[1]))
    cost, s, model = best
    return SegmentationFit(model=model, cost=float(cost), seed=s, assigned=model.transform(assembler.transform(z)))


def silhouette(assigned: DataFrame) -> DataFrame:
    """M4: one row: the mean silhouette with squared Euclidean distance over the standardised features.

    A point's mean squared distance to a cluster needs only the cluster's size,
    mean and mean square, so one grouped aggregate (k rows, broadcast) and one
    pass over the points give it exactly; clusters of one point score 0.
    """
    z = [f"{c}_z" for c in FEATURES]
    norm = sum((F.col(c) * F.col(c) for c in z), F.lit(0.0))
    stats = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(norm).alias("sq"), *[F.avg(c).alias(f"m_{c}") for c in z])
    # k rows: a bounded array in a scalar subquery.
    clusters = stats.agg(F.collect_list(F.struct("cluster", "n", "sq", *[f"m_{c}" for c in z]))).scalar()
    far = F.transform("_clusters", lambda s: F.struct(
        s["cluster"].alias("cluster"), s["n"].alias("n"),
        F.greatest(F.lit(0.0), norm + s["sq"] - 2 * sum((F.col(c) * s[f"m_{c}"] for c in z), F.lit(0.0))).alias("d")))
    x = assigned.withColumn("_clusters", clusters).withColumn("_far", far)
    own = F.get(F.filter("_far", lambda s: s["cluster"] == F.col("cluster")), F.lit(0))
    x = x.select(own.alias("own"), F.array_min(F.transform(F.filter("_far", lambda s: s["cluster"] != F.col("cluster")), lambda s: s["d"])).alias("b"))
    a = F.col("own.d") * F.col("own.n") / (F.col("own.n") - 1)
    score = F.when(F.col("own.n") == 1, 0.0).otherwise((F.col("b") - a) / F.nullif(F.greatest("b", a), F.lit(0.0)))
    return x.agg(F.avg(F.coalesce(score, F.lit(0.0))).alias("silhouette_squared_euclidean"))


def euclidean_silhouette(assigned: DataFrame, cols: list[str], sample: int = 1000, seed: int = 42, id_col: str = "customer_unique_id",
                         confidence: float = 0.95) -> DataFrame:
    """M4: one row: the mean Euclidean silhouette of a bounded sample, n_sample, and ``bound``.

    The sample is M11's (the smallest md5 of seed and id). Its points' distances
    are exact: every point of the table, block by block, adds its distance to
    each sampled point to that point's total for the block's cluster, so a task
    holds the sample and one Arrow batch, and sends one total for each sampled
    point and cluster. Scores lie in [-1, 1], so by Hoeffding's inequality the
    mean over all points is within ``bound`` of the sample's with the given
    confidence (0 where the sample is the whole table). Points alone in their
    cluster score 0, as do points of a single cluster; rows with a null in
    ``cols`` or no cluster take no part.
    """
    import numpy as np
    import pyarrow as pa

    whole = assigned.filter(F.col("cluster").isNotNull()).dropna(subset=cols).select(id_col, F.col("cluster").cast("int").alias("cluster"),
                                                                                     *[F.col(c).cast("double").alias(c) for c in cols])
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    picked = whole.orderBy(key.asc_nulls_last(), F.col(id_col).asc_nulls_last()).limit(sample).collect()   # at most ``sample`` rows
    spark = assigned.sparkSession
    if not picked:
        return spark.createDataFrame([(None, 0, None)], "silhouette double, n_sample bigint, bound double")
    points = np.array([[r[c] for c in cols] for r in picked], float)

    def totals(batches):
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols])
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            for at in range(0, len(rows), 2000):
                far = np.sqrt(((rows[at:at + 2000, None, :] - points[None]) ** 2).sum(2))
                for c in np.unique(cluster[at:at + 2000]).tolist():
                    own = cluster[at:at + 2000] == c
                    n, total = held.get(c, (0, 0.0))
                    held[c] = n + int(own.sum()), total + far[own].sum(0)
        for c, (n, total) in held.items():
            k = len(points)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(np.full(k, c, np.int32)), pa.array(np.full(k, n)), pa.array(total)],
                                             names=["point", "cluster", "n", "total"])

    sums = whole.select("cluster", *cols).mapInArrow(totals, "point bigint, cluster int, n bigint, total double") \
        .groupBy("point", "cluster").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    mine = spark.createDataFrame([(i, r["cluster"]) for i, r in enumerate(picked)], "point bigint, mine int")
    own = F.col("cluster") == F.col("mine")
    scored = sums.join(F.broadcast(mine), "point").groupBy("point").agg(   # the sample's points
        F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    score = F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0))
    left_out = whole.count() > len(picked)
    bound = math.sqrt(2 * math.log(2 / (1 - confidence)) / len(picked)) if left_out else 0.0
    return scored.agg(F.avg(score).alias("silhouette"), F.count(F.lit(1)).alias("n_sample"), F.lit(bound).alias("bound"))


def squared_distances(fit: SegmentationFit) -> DataFrame:
    """Each row of the assignment with ``own`` (squared distance to its cluster's centre) and ``nearest`` (to the nearest one)."""
    z = [f"{c}_z" for c in FEATURES]
    d = [sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(z, centre, strict=True)), F.lit(0.0))
         for centre in fit.model.clusterCenters()]
    return fit.assigned.withColumn("own", F.get(F.array(*d), F.col("cluster"))).withColumn("nearest", F.array_min(F.array(*d)))


def inertia(fit: SegmentationFit) -> DataFrame:
    """M5: one row: the within-cluster sum of squared distances over the assigned rows."""
    return squared_distances(fit).agg(F.sum("own").alias("inertia"))


# ---------------------------------------------------------------- M6 – M10

def cluster_medians(assigned: DataFrame, group: str = "cluster") -> DataFrame:
    """Exact medians of the three features per group (one distributed numbering)."""
    checkpoint_dir(assigned.sparkSession)
    base = assigned.select(group, *FEATURES).checkpoint(eager=True)
    return exact_medians(base, FEATURES, [group])


def label_clusters(assigned: DataFrame, labels: dict[int, str] = SEGMENT_LABELS) -> DataFrame:
    """M6: one row per cluster: medians, score and business label.

    score = -avg_rank(recency median) + avg_rank(frequency median) + avg_rank(monetary median),
    ties sharing the average rank; positions by score desc then cluster id.
    The frame has k rows, so its windows are bounded.
    """
    meds = cluster_medians(assigned)

    def avg_rank(c: str):
        return F.rank().over(Window.orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy(c)) - 1) / 2.0

    scored = meds.withColumn("score", -avg_rank("recency_med") + avg_rank("frequency_med")
                             + avg_rank("monetary_med"))
    pos = F.row_number().over(Window.orderBy(F.col("score").desc(), F.col("cluster").asc()))
    label_map = F.create_map(*[x for p, name in sorted(labels.items()) for x in (F.lit(p), F.lit(name))])
    labelled = scored.withColumn("position", pos).withColumn("segment", label_map[F.col("position")])
    # k rows; a reliable copy so every consumer reuses one evaluation of the medians.
    return labelled.checkpoint(eager=True)


def assign_segments(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """M9 table: (customer_unique_id, recency, frequency, monetary, segment); cluster id dropped."""
    # ``labels`` has one row per cluster (k rows): a bounded broadcast.
    return assigned.join(F.broadcast(labels.select("cluster", "segment")), "cluster") \
        .select("customer_unique_id", "recency", "frequency", "monetary", "segment")


def segment_sizes(segments: DataFrame) -> DataFrame:
    """M7: customers per segment."""
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("n_customers"))


def run_metrics(fit: SegmentationFit, segments: DataFrame) -> DataFrame:
    """M8: one row per run metric (name, value), all computed from the assigned rows and the segments."""
    n_clusters = fit.assigned.agg(F.lit("n_clusters").alias("metric"), F.count_distinct("cluster").cast("double").alias("value"))
    score = silhouette(fit.assigned).select(F.lit("silhouette_squared_euclidean").alias("metric"),
                                            F.round("silhouette_squared_euclidean", 4).alias("value"))
    cost = inertia(fit).select(F.lit("inertia").alias("metric"), F.round("inertia", 2).alias("value"))
    n_customers = segments.agg(F.lit("n_customers").alias("metric"), F.count(F.lit(1)).cast("double").alias("value"))
    per_seg = segment_sizes(segments).select(
        F.concat(F.lit("n_"), F.regexp_replace("segment", " ", "_")).alias("metric"),
        F.col("n_customers").cast("double").alias("value"))
    return n_clusters.unionByName(score).unionByName(cost).unionByName(n_customers).unionByName(per_seg)


def save_run(fit: SegmentationFit, segments: DataFrame, root: str) -> str:
    """M8/M9: write a run: the segments as a new table version, its metrics under the same version, the fitted model.

    Versions are immutable and a reader takes the newest complete one, so a
    failed run leaves the former tables in place. Returns the segments' path.
    """
    path = write_table(segments, root, "customer_segments")
    run = path.rsplit("=", 1)[1]
    run_metrics(fit, segments).withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{root.rstrip('/')}/run_metrics")
    fit.model.write().overwrite().save(f"{root.rstrip('/')}/kmeans_model/v={run}")
    return path


def read_run(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, KMeansModel]:
    """The newest complete run that ``save_run`` wrote: its segments, its metrics (metric, value) and its model."""
    run = latest_version(spark, root, "customer_segments").rsplit("=", 1)[1]
    metrics = spark.read.parquet(f"{root.rstrip('/')}/run_metrics/run={run}").select("metric", "value")
    return read_table(spark, root, "customer_segments"), metrics, KMeansModel.load(f"{root.rstrip('/')}/kmeans_model/v={run}")


def segment_profile(segments: DataFrame) -> DataFrame:
    """Per segment: size and exact medians of recency, frequency, monetary."""
    sizes = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("nb_clients"))
    meds = cluster_medians(segments, group="segment")
    return sizes.join(meds, "segment").select(
        "segment", "nb_clients",
        *[round_double(f"{c}_med", 6).alias(f"{c}_med") for c in FEATURES])


# ---------------------------------------------------------------- M11 – M13

def sample_customers(df: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """A reproducible sample of min(n, rows): the n smallest md5(seed:id), rows without an id last.

    One take-ordered: every task keeps its n smallest rows and one merge takes
    the n smallest of those.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("customer_unique_id")))
    return df.orderBy(key.asc_nulls_last(), F.col("customer_unique_id").asc_nulls_last()).limit(n)


def cap_outliers(sample: DataFrame, q: float = 0.99, cols: list[str] = FEATURES) -> DataFrame:
    """Cap each feature at its exact ``q`` quantile (linear interpolation) over the sample.

    The sample is bounded (M11), so the exact percentile buffers at most n
    values; all caps come from one aggregate pass.
    """
    caps = sample.agg(F.struct(*[F.percentile(F.col(c).cast("double"), q).alias(c) for c in cols])).scalar()
    return sample.select(*[F.least(F.col(f.name).cast("double"), caps[f.name]).alias(f.name) if f.name in cols
                           else F.col(f.name) for f in sample.schema.fields])


#: Size parameter of the quantile sketches; a quantile's rank is off by at most RANK_ERROR of the rows (with 99 % confidence).
SKETCH_K, RANK_ERROR = 400, 0.0075


def quantile_states(df: DataFrame, by: list[str], cols: list[str] = FEATURES) -> DataFrame:
    """A mergeable quantile sketch (KLL) of each column for each group ``by``: bounded bytes, whatever the number of rows."""
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_K)).alias(c) for c in cols]
    return df.groupBy(*by).agg(*sketches)


def merge_states(states: DataFrame, by: list[str] | None = None, cols: list[str] = FEATURES) -> DataFrame:
    """Sketches of several groups as one: days into months, batches into a table."""
    return states.groupBy(*(by or [])).agg(*[F.kll_merge_agg_double(c, F.lit(SKETCH_K)).alias(c) for c in cols])


def sketch_quantile(state: str, q: float) -> Column:
    """The value at rank ``q`` of a sketch column."""
    return F.kll_sketch_get_quantile_double(F.col(state), F.lit(float(q)))


def sketch_rank_check(df: DataFrame, state: DataFrame, quantiles: tuple[float, ...], cols: list[str] = FEATURES) -> DataFrame:
    """(column_name, q, n_values, within_bound): whether each quantile's exact rank in ``df`` is within RANK_ERROR of ``q``.

    A value's rank spans from the share of smaller rows to that of rows not greater.
    """
    values = state.select(F.struct(*[F.struct(*[sketch_quantile(c, q).alias(f"q{i}") for i, q in enumerate(quantiles)]).alias(c) for c in cols])).scalar()
    held = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).withColumn("at", values)
    counted = held.agg(*[f for c in cols for i, _ in enumerate(quantiles) for f in (
        F.avg((F.col(c) < F.col(f"at.{c}.q{i}")).cast("double")).alias(f"{c}_lt{i}"), F.avg((F.col(c) <= F.col(f"at.{c}.q{i}")).cast("double")).alias(f"{c}_le{i}"))],
        *[F.count(c).alias(f"{c}_n") for c in cols])
    return counted.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(float(q)).alias("q"), F.col(f"{c}_n").alias("n_values"),
        ((F.col(f"{c}_lt{i}") <= q + RANK_ERROR) & (F.col(f"{c}_le{i}") >= q - RANK_ERROR)).alias("within_bound"))
        for c in cols for i, q in enumerate(quantiles)])))


def cap_outliers_approx(df: DataFrame, q: float = 0.99, cols: list[str] = FEATURES) -> DataFrame:
    """M12 over any number of rows: each feature capped at the sketch's ``q`` quantile, whose rank is within RANK_ERROR of ``q``."""
    caps = merge_states(quantile_states(df, [], cols), None, cols).select(F.struct(*[sketch_quantile(c, q).alias(c) for c in cols])).scalar()
    return df.select(*[F.least(F.col(f.name).cast("double"), caps[f.name]).alias(f.name) if f.name in cols else F.col(f.name) for f in df.schema.fields])


def pca_projection(capped: DataFrame, k: int = 2) -> DataFrame:
    """2-D PCA of the re-standardised capped sample, with explained variance (%).

    Component signs are fixed so that each component's largest loading is positive.
    """
    z = standardize(capped)
    vec = VectorAssembler(inputCols=[c + "_z" for c in FEATURES], outputCol="features").transform(z)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(vec)
    loadings = model.pc.toArray()            # 3 x k, bounded by the feature count
    signs = []
    for j in range(k):
        col = loadings[:, j]
        signs.append(1.0 if col[abs(col).argmax()] >= 0 else -1.0)
    var = [float(x) * 100.0 for x in model.explainedVariance.toArray()]
    arr = vector_to_array(F.col("pcs"))
    keep = [c for c in capped.columns if c not in FEATURES]
    return model.transform(vec).select(
        *keep, *FEATURES,
        *[(arr[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)],
        *[F.lit(var[j]).alias(f"pc{j + 1}_variance_pct") for j in range(k)],
    )
