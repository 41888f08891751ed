import random

import pytest

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None, "", "  ", " \n x", "a" * 1500, "ab" * 400 + "é" * 100, "x  y\t\n  z \x1c \x1f q  w  k", "日本語 テスト　 漢字", "Ⅷ ½ ²x ٣٤ ",
    "it's we'll I'D", "\r\n\r\n  \r\n a", "<|endoftext|> x <|startoftext|>", "\U0001f600" * 20, "é É İI ΑΣ ſ", "word " * 3000,
]


def odd_rows(seed=1, more=60):
    """(id, text) rows of odd texts, random ones, a repeated row and a null id."""
    rnd = random.Random(seed)
    texts = ODD_TEXTS + ["".join(rnd.choice("ab \n\té.1,　\x1cÀS\x85\xa0²") for _ in range(rnd.randint(1, 200))) for _ in range(more)]
    rows = list(enumerate(texts))
    return rows + [rows[9], (None, "no id")]


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Odd rows with further columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, t, "x", 1.5, i) for i, t in odd_rows()],
                                 "doc_id long, text string, score string, ids double, part long").repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
