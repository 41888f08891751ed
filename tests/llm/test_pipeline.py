"""The pipeline's stages on the smallest documents, each against a plain version of its decision."""
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderlake.llm import queries, toxicity
from orderlake.llm._io import stage
from orderlake.llm.oracle import ORACLES
from tests.llm.conftest import SF
from tests.llm.test_jaccard import plain


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF), name))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").distinct().collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity_stage_drops_what_the_query_rejects(spark, stages):
    rejected = {r.doc_id for r in queries.op10_toxicity(spark, SF).collect() if r.score >= toxicity.TOXIC}
    assert ids(stages[1]) == ids(stages[0]) - rejected


def test_language_stage_keeps_texts_of_known_languages(spark, stages):
    odd = spark.createDataFrame([(10**6, "1 2 3 !!", None, "s", 8), (10**6 + 1, "日本語漢字" * 20, None, "s", 100)], stages[1].schema)
    kept = corpus_pipeline.keep_known_languages(spark, stages[1].unionByName(odd), SF)
    assert ids(kept) == ids(stages[2]) == ids(stages[1])


def test_language_stage_keeps_clean_texts_of_a_word(spark, stages):
    short = ["I", "pdf", "Wow!", "Fin", "URL", "A.", "Jazz", "ok"]
    foreign = ["日", "Привет", "日本語漢字 ok", "1", "?!"]
    odd = spark.createDataFrame([(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(short + foreign)], stages[1].schema)
    kept = ids(corpus_pipeline.keep_known_languages(spark, stages[1].unionByName(odd), SF))
    assert {i - 10**6 for i in kept if i >= 10**6} == set(range(len(short)))


def test_language_stage_drops_planted_foreign_texts(spark, stages):
    """Clean texts of the stage's own input, respelled in letters that no language has: all of these go, all clean ones stay."""
    clean = [r for r in stages[1].collect() if r.text and any(c.isalpha() for c in r.text)]
    greek = [(10**6 + i, "".join(chr(0x3B1 + ord(c.lower()) % 24) if c.isalpha() else c for c in r.text), r.lang, r.source, r.n_chars)
             for i, r in enumerate(clean[:120])]
    kept = ids(corpus_pipeline.keep_known_languages(spark, stages[1].unionByName(spark.createDataFrame(
        [(i, t, None, s, n) for i, t, _, s, n in greek], stages[1].schema)), SF))
    assert not {i for i in kept if i >= 10**6} and kept == ids(stages[1])


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert ids(stages[3]) == {component for _, _, component in plain(rows)}
    assert stages[3].count() == len(ids(stages[3]))


def test_one_row_without_an_id_stays_of_each_group_that_has_none(spark, stages):
    long = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    near = [" ".join(long), " ".join([*long[:-1], "x"]), " ".join([*long[:-1], "y"])]
    rows = [(None, t) for t in [*near, near[0], "alone here", "alone  here", "", " ", None, " ".join([*other[:-1], "z"])]] + [(7, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert [r for r in kept if r[0] is not None] == [(7, " ".join(other))]
    bare = [t for i, t in kept if i is None]
    assert len([t for t in bare if t in near]) == 1 and len([t for t in bare if t and t.startswith("alone")]) == 1
    assert sorted(t or "-" for t in bare if t is None or not t.strip()) == [" ", "-", "-"] and len(bare) == 5


def test_redaction_leaves_no_base_span(stages):
    from orderlake.llm.pii import base_spans

    after = {r.doc_id: r for r in stages[4].collect()}
    for r in stages[3].collect():
        text = after[r.doc_id].text
        assert not base_spans(text) and after[r.doc_id].n_chars == len(text)
        if not base_spans(r.text) and not any(c.isdigit() for c in r.text):
            assert text == r.text


def test_packing_holds_all_ids(stages):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages[4].collect()}
    got = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).collect()
    assert {r.doc_id: r.n for r in got} == want == {r.doc_id: r.t for r in got}


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF).schema == stages[-1].schema and corpus_pipeline.ORACLE_SQL is None


def test_registered_names():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == [*range(1, 14)] and set(ORACLES) <= set(queries.QUERIES)


def test_op3_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = con.execute(ORACLES["op3_shard_documents"])
    names = [d[0] for d in cur.description]
    got = queries.op3_shard_documents(spark, SF)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cur.fetchall())


def test_a_worker_lets_earlier_operators_go(spark):
    """What the language stage keeps in a worker is gone once the personal-data stage runs there."""
    from orderlake.llm import _io, language
    language._PARSERS[1] = "parser"
    _io.let_go()
    assert not language._PARSERS
