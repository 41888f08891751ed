"""Operator 11 against a plain computation, on odd texts and runs of several words."""
import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from orderlake.llm import resampling
from tests.llm.conftest import odd_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TARGET = ["the ab cat sat é on the mat", "ab ab word word", None, "", "日本語 テスト"]


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def runs(text, words):
    found = WORD.findall(lower(text))
    return [" ".join(found[i:i + k]) for k in range(1, words + 1) for i in range(len(found) - k + 1)]


def plain(rows, target, words, buckets, percent, least):
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    s = Counter(bucket(r) for _, t in rows for r in runs(t, words))
    t = Counter(bucket(r) for x in target for r in runs(x, words))
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        found = runs(text, words)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(WORD.findall(lower(text))), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for place, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = place + 1
    return Counter(map(tuple, out))


@pytest.mark.parametrize(("words", "buckets"), [(1, 10_000), (3, 97)])
def test_resample_equals_the_plain_computation(spark, odd_docs, words, buckets):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = resampling.resample(odd_docs, target, percent=30, least_words=2, words=words, buckets=buckets)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == plain(odd_rows(), TARGET, words, buckets, 30, 2)


def test_carried_columns_keep_their_names(spark, odd_docs):
    target = spark.createDataFrame([("ab",)], "text string")
    got = resampling.resample(odd_docs, target, carry=["score", "text"])
    assert got.columns == ["doc_id", "score", "text", "n_words", "n_features", "weight", "score_", "rank"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(odd_rows())


def test_empty_tables(spark, no_docs, odd_docs):
    target = spark.createDataFrame([("ab",)], "text string")
    assert resampling.resample(no_docs, target).count() == 0
    none = resampling.resample(odd_docs, target.limit(0), percent=30, least_words=2).collect()
    assert Counter(map(tuple, none)) == plain(odd_rows(), [], 1, 10_000, 30, 2)


def test_words_of_a_batch():
    at, numbers, spelled = resampling.numbered_words(pa.array(["", None, "--A b--a", " ", "É1"]))
    assert at.tolist() == [0, 0, 0, 3, 3, 4]
    assert [spelled[i].decode() for i in numbers] == ["a", "b", "a", "É1"]
