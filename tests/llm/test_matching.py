"""Operator 12 against a plain trie of nested counts."""
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.llm import matching
from tests.llm.conftest import odd_rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def symbols(text):
    return [*(text or "").encode(), "end"]


def tokens(text):
    return [*WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)})), "<end>"]


class Trie:
    def __init__(self, texts, order):
        self.order, self.follow = order, defaultdict(Counter)
        for t in texts:
            seq = ["start"] * order + symbols(t)
            for i in range(order, len(seq)):
                for k in range(order + 1):
                    self.follow[tuple(seq[i - k:i])][seq[i]] += 1

    def probability(self, before, symbol):
        p, out = 1.0, set()
        for k in range(self.order, -1, -1):
            seen = self.follow.get(tuple(before[len(before) - k:]))
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in out}
            total = sum(left.values()) + (len(left) if len(seen) < 257 else 0)
            if symbol in left:
                return p * left[symbol] / total
            if left:
                p *= len(left) / total
            out = set(seen)
        return p / (257 - len(out))

    def score(self, text):
        seq = ["start"] * self.order + symbols(text)
        return sum(math.log10(self.probability(seq[i - self.order:i], seq[i])) for i in range(self.order, len(seq)))


def plain(rows, learned, order):
    trie = Trie([t for (_, t), y in zip(rows, learned, strict=True) if y], order)
    count = Counter(w for (_, t), y in zip(rows, learned, strict=True) if y for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for (i, t), y in zip(rows, learned, strict=True):
        found = tokens(t)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        out.append((i, y, len(found), sum(count[w] > 0 for w in found), n, round(base, 6), round(trie.score(t), 6)))
    return Counter(out)


def rounded(df):
    return Counter((*r[:5], round(r[5], 6) + 0.0, round(r[6], 6) + 0.0) for r in df.collect())


@pytest.mark.parametrize("order", [0, 2, 4])
def test_scores_equal_the_plain_trie(spark, odd_docs, order, monkeypatch):
    monkeypatch.setattr(matching, "CHUNK_BYTES", 300)
    monkeypatch.setattr(matching, "BLOCK_BYTES", 1500)
    rows = [(i, t) for i, t in odd_rows(more=30)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block long, learned string").repartition(3)
    got = matching.score(docs, F.col("doc_id") % 3 != 0, order)
    assert got.columns == ["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert rounded(got) == plain(rows, [i is not None and i % 3 != 0 for i, _ in rows], order)


def test_probabilities_of_all_next_symbols_add_up_to_one():
    trie = Trie(["abracadabra", "abba", None, "cab"], 2)
    for before in (["start", "start"], [97, 98], [120, 121], [98, 120]):
        assert math.isclose(sum(trie.probability(before, s) for s in [*range(256), "end"]), 1.0)


def test_nothing_learned_and_no_rows(spark, no_docs):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in matching.score(docs, F.lit(False)).collect()}
    assert got[1].score == pytest.approx(3 * math.log10(1 / 257)) and got[2].score == pytest.approx(math.log10(1 / 257))
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[1].base_score) == (2, 0, 0, 0.0)
    assert matching.score(no_docs, F.lit(True)).count() == 0


def test_known_texts_are_likelier_than_noise(spark):
    text = "the cat sat on the mat and the dog lay on the rug "
    docs = spark.createDataFrame([(i, text * 3) for i in range(6)] + [(100, text), (101, text[::-1]), (102, "\x01\x02" * 25)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in matching.score(docs, F.col("doc_id") < 6).collect()}
    assert got[100] > got[101] > got[102]
