"""Operator 7 and the components against all pairs."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderlake.llm import jaccard
from orderlake.llm._components import components


def plain(rows, threshold=80):
    """(id, set size, component) of each row, by counting shared shingles of all pairs."""
    sets, holders = [], defaultdict(list)
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= threshold * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return Counter((k, len(s), low.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed):
    """Small sets, near copies, a large group of near copies, shared passages, copies, odd rows."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(50)]
    rows = []
    for _ in range(150):
        t = [rnd.choice(words) for _ in range(rnd.randint(1, 45))]
        for _ in range(rnd.randint(1, 4)):
            u = list(t)
            for _ in range(rnd.randint(0, 2)):
                u[rnd.randrange(len(u))] = rnd.choice(words)
            rows.append(" ".join(u))
    t = [rnd.choice(words) for _ in range(120)]
    for i in range(350):
        u = list(t)
        u[rnd.randrange(len(u))] = f"x{i}"
        rows.append(" ".join(u))
    passage = " ".join(rnd.choice(words) for _ in range(40))
    rows += [f"{passage} " + " ".join(f"y{i}_{j}" for j in range(rnd.randint(3, 60))) for i in range(150)]
    rows += [rows[5]] * 60
    rows = list(enumerate(rows)) + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (None, "one two three"), (10**6 + 4, "One two\nTHREE"),
                                    (10**6 + 4, "One two\nTHREE"), (10**6 + 5, "é É " * 2000), (None, "all alone here")]
    return rows


@pytest.mark.parametrize("frequent,light,cell", [(1_000_000, 60, 2048), (50, 4, 25)])
def test_op7_equals_all_pairs(spark, frequent, light, cell, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "LIGHT_MOST", light)
    monkeypatch.setattr(jaccard, "PART_NODES", 40)
    rows = corpus(3)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, key string, n long").repartition(5)
    assert Counter(tuple(r) for r in jaccard.near_duplicates(df).collect()) == plain(rows)


def test_op7_passages_in_many_documents(spark, monkeypatch):
    """Texts made up of passages that a quarter of all texts share: no pair leaves its cell but those that link."""
    rnd = random.Random(11)
    passages = [" ".join(f"p{i}_{rnd.randrange(10**6)}" for _ in range(50)) for i in range(12)]
    low, rows, want = {}, [], {}
    for i in range(4000):
        some = tuple(sorted(rnd.sample(range(12), 3)))
        rows.append((i, " ".join(passages[j] for j in some) + f" a{i} b{i}"))
        want[i] = low.setdefault(some, i)
    monkeypatch.setattr(jaccard, "CELL", 100)
    found, sent = jaccard._met_in_cells, []

    def counted(*args):
        pairs = found(*args)
        sent.append(pairs.distinct().count())
        return pairs

    monkeypatch.setattr(jaccard, "_met_in_cells", counted)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(sent) == 1 and sent[0] <= sum(n * (n - 1) // 2 for n in Counter(want.values()).values())  # half of all pairs share a passage


@pytest.mark.parametrize("threshold", [70, 75, 101])
def test_op7_refuses_thresholds_that_its_lists_do_not_serve(no_docs, threshold):
    with pytest.raises(ValueError):
        jaccard.near_duplicates(no_docs, threshold=threshold)


def test_op7_empty(spark, no_docs):
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_light_limit_follows_the_costs():
    assert jaccard.light_limit(10**6, np.zeros(0), 80) < jaccard.light_limit(10**6, np.full(2000, 100), 80) <= jaccard.LIGHT_MOST


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(300, 299), (299, 298), (7, 7), (301, 300)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {i: 298 for i in range(298, 302)}
    assert got == want
