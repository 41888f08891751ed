"""Operator 13 against trees built in plain Python."""
import hashlib
import zlib
from collections import Counter

import pytest

from orderlake.llm import merkle
from tests.llm.conftest import odd_rows

FIELDS = ["doc_id", "source", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in row])


def tree(nodes):
    """(top hash, for each node its path of (left, right))."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 16, len(nodes))) for a in range(0, len(nodes), 16)]
        for run in runs:
            for j in run:
                around = (h_join(nodes, run.start, j), h_join(nodes, j + 1, run.stop))
                for i in under[j]:
                    paths[i].append(around)
        under = [[i for j in run for i in under[j]] for run in runs]
        nodes = [h(*(nodes[j] for j in run)) for run in runs]
    return nodes[0], paths


def h_join(nodes, a, b):
    return "".join(nodes[a:b])


def plain(rows):
    groups = {}
    for i, source, text in rows:
        changed = text.translate({c: c + 32 for c in range(65, 91)}) if text is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else text
        groups.setdefault(source, []).append((i, leaf((i, source, text)), leaf((i, source, changed))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree([r[1] for r in groups[s]])
    root, above = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, above, strict=True):
        for (i, own, changed), path in zip(groups[s], trees[s][1], strict=True):
            path, folded = path + top, changed
            for left, right in path:
                folded = h(left, folded, right)
            out.append((i, own, trees[s][0], root, h(*(x for p in path for x in p)), folded, folded == root))
    return Counter(out)


@pytest.mark.parametrize("sources", [1, 2, 40])
def test_manifest_equals_plain_trees(spark, sources):
    names = [None, "", "é", "z", "A", *(f"s{i}" for i in range(40))][:sources]
    big = names[-1]
    rows = [(i, names[n % sources], t) for n, (i, t) in enumerate(odd_rows())] + [(10_000 + i, big, f"Row {i}") for i in range(300)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, pos long, leaf string").repartition(5)
    got = merkle.manifest(docs, FIELDS, merkle.tampered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "proof_sha256", "folded_root", "verified"]
    told = got.drop("path").collect()
    assert Counter(map(tuple, told)) == plain(rows)
    assert len({r.root for r in told}) == 1 and not all(r.verified for r in told)


def test_every_row_verifies_without_a_change(spark, odd_docs):
    got = merkle.manifest(odd_docs, ["doc_id", "text"], group_col="score").collect()
    assert len(got) == len(odd_rows()) and all(r.verified for r in got)


def test_small_tables(spark, no_docs):
    none = no_docs.withColumnRenamed("lang", "source")
    assert merkle.manifest(none, FIELDS).count() == 0
    one = spark.createDataFrame([(1, "s", None)], "doc_id long, source string, text string")
    r = merkle.manifest(one, FIELDS).first()
    assert r.leaf == r.subroot == r.root == r.folded_root == leaf((1, "s", None)) and r.proof_sha256 == h("") and r.verified and not r.path
