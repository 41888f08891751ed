"""Operators 2 and 5 against all pairs."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import ann, pivots

BAD = [None, [], [0.0, 0.0, 0.0, 0.0], [1.0, None, 0.0, 0.0], [float("nan"), 1.0, 0.0, 0.0], [float("inf"), 1.0, 0.0, 0.0]]


@pytest.fixture(scope="module")
def vectors():
    """Random vectors, groups of near copies, equal ones."""
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=24)) for i in range(700)]
    for g in range(12):
        middle = rnd.normal(size=24)
        rows += [(len(rows) + j, middle + rnd.normal(scale=0.04 + 0.03 * (g % 4), size=24)) for j in range(20)]
    rows += [(2000 + i, rows[3][1]) for i in range(40)]
    return [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in rows]


def test_op2_recall_and_scores(spark, vectors):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v, _ in vectors] + [(9000 + 50 * i, v, "x", "y") for i, v in enumerate(BAD) if v != []],
                               "vec_id long, embedding array<float>, rank string, id string").repartition(4)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 10 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ids, x = np.array([i for i, _, _ in vectors]), np.array([v for _, v, _ in vectors])
    norm = np.sqrt((x * x).sum(1))
    hits = total = 0
    for q in np.flatnonzero(ids % 10 == 0):
        cos = (x * x[q]).sum(1) / (norm * norm[q])
        cos[q] = -2
        best = np.lexsort((ids, -cos))[:5]
        assert sorted(got[ids[q]]) == [1, 2, 3, 4, 5]
        for rank, (vec, score) in got[ids[q]].items():
            assert score == pytest.approx(cos[np.flatnonzero(ids == vec)[0]], abs=1e-12)
            assert rank == 1 or (-got[ids[q]][rank - 1][1], got[ids[q]][rank - 1][0]) < (-score, vec)
        hits += len({v for v, _ in got[ids[q]].values()} & set(ids[best].tolist()))
        total += 5
    assert hits / total >= 0.9
    assert set(got) == set(ids[ids % 10 == 0].tolist())


def test_op2_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_op2_lengths_and_null_ids(spark):
    """Vectors of two lengths are two tables; rows without an id take no part."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [1.0, 0.2, 0.0]), (None, [1.0, 0.0]), (5, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(df, F.lit(True)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (1, 1, 0), (2, 1, 4), (2, 2, 3), (3, 1, 4), (3, 2, 2), (4, 1, 2), (4, 2, 3)]


def test_multi_index_retrieves_every_code_within_the_radius():
    codes = np.random.default_rng(1).integers(0, 256, (500, 8)).astype(np.uint8)
    index = ann.MultiIndex(codes)
    for radius in (0, 5, 8, 17, 25, 31, 64):
        for q in (0, 77):
            near = np.unpackbits(codes ^ codes[q], axis=1).sum(1) <= radius
            assert index.within(codes[q], radius).tolist() == np.flatnonzero(near).tolist()


def test_op5_links_and_components(spark, vectors):
    bad = [(9000 + i, v, 1) for i, v in enumerate(BAD)] + [(9100, vectors[3][1], None), (9101, [1.0, 2.0], 0)]
    rows = [*vectors, *bad]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<float>, label int, node string, n long").repartition(4)
    old, pivots.CHUNK = pivots.CHUNK, 32  # so that lists are cut
    try:
        got = {r.vec_id: r for r in pivots.linked_vectors(df).collect()}
    finally:
        pivots.CHUNK = old
    x = np.array([v for _, v, _ in vectors])
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    ids, labels = np.array([i for i, _, _ in vectors]), np.array([c for _, _, c in vectors])
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(linked, low[None, :], 10**6).min(1))
        if (new == low).all():
            break
        low = new
    found = sum(got[i].n_links for i in ids)
    assert found <= linked.sum() and found >= 0.97 * linked.sum()
    assert np.mean([got[i].component_id == c for i, c in zip(ids.tolist(), low.tolist(), strict=True)]) >= 0.97
    assert all(got[i].n_links >= 12 for i in range(2000, 2040))
    for i, _, _ in bad:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert pivots.linked_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("count, size", [(256, 3000), (4096, 6000)])
def test_op5_group_of_near_copies_loses_no_link(spark, monkeypatch, count, size):
    monkeypatch.setattr(pivots, "FEWEST_PIVOTS", count)
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(size, 64))
    x[: size // 3] = x[0] + rnd.normal(size=(size // 3, 64)) * rnd.uniform(0.05, 0.3, (size // 3, 1))
    x = x.astype(np.float32).astype(np.float64)
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    assert want.sum() > (size // 3) ** 2 / 2
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: r.n_links for r in pivots.linked_vectors(df).collect()}
    assert [got[i] for i in range(size)] == want.tolist()


def test_op5_complete_wherever_the_pivots_are(spark, monkeypatch):
    """Groups that hold no pivot, and vectors between pivots: with core=-1 every link is found."""
    monkeypatch.setattr(pivots, "MOST_PIVOTS", 16)
    rnd = np.random.default_rng(11)
    x = np.concatenate([rnd.normal(size=(300, 8)), np.repeat(rnd.normal(size=(60, 8)), 10, 0) + rnd.normal(scale=0.25, size=(600, 8))])
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    linked = (unit @ unit.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in pivots.linked_vectors(df, core=-1).collect()}
    assert linked.sum() > 2000
    assert [got[i].n_links for i in range(len(x))] == linked.sum(1).tolist()
    low = np.arange(len(x))
    while (new := np.minimum(low, np.where(linked, low[None, :], len(x)).min(1))).tolist() != low.tolist():
        low = new
    assert [got[i].component_id for i in range(len(x))] == low.tolist()


def test_op5_short_vectors_among_longer_ones(spark):
    rnd = np.random.default_rng(10)
    short = rnd.normal(size=5) + rnd.normal(scale=0.05, size=(400, 5))
    rows = [(i, v, 0) for i, v in enumerate([*short.tolist(), *rnd.normal(size=(400, 24)).tolist()])]
    got = {r.vec_id: r.n_links for r in pivots.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = short / np.sqrt((short * short).sum(1))[:, None]
    assert [got[i] for i in range(400)] == ((unit @ unit.T >= 0.93).sum(1) - 1).tolist()
