"""Operators 1, 4 and 6 against the libraries themselves, text by text."""
import json
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from orderlake.llm import _batch, _io, _tokens, bpe, packing, token_files
from orderlake.llm._io import new_folder
from orderlake.llm._text import space_chunks
from orderlake.llm._tokens import ids_of
from tests.llm.conftest import odd_rows

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def library_ids(file, end_id):
    tok = Tokenizer.from_file(P.path(file))
    return lambda text: np.array([*tok.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")


def test_space_chunks_join_to_the_text():
    for _, t in odd_rows():
        assert "".join(space_chunks(t or "")) == (t or "")


@pytest.mark.parametrize("style", ["task", "spark"])
def test_op1_equals_tiktoken_and_decodes(odd_docs, style):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    got = bpe.decode(bpe.encode(odd_docs, RANKS, P.PATTERN, style=style), RANKS).collect()
    assert Counter((r[0], tuple(r[1]), bytes(r[2])) for r in got) == Counter(
        (i, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in odd_rows())


def test_op1_long_word_fold_equals_short_fold():
    ranks = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for word in ("a" * 700, "abc" * 300, "ünïcödé" * 60):
        assert bpe.fold_word(word.encode(), ranks) == enc.encode_ordinary(word)


def test_op1_folds_agree(spark):
    """Words of every length, all bytes, repeated letters: the array fold, the heap fold, Spark's fold and the library."""
    import random

    rnd, ranks = random.Random(5), bpe.read_ranks(RANKS)
    words = {bytes(rnd.choice(b"abthein er\xc3\xa9\x00\xff") for _ in range(rnd.randint(1, 40))) for _ in range(800)}
    words = sorted(words | {b"a" * n for n in range(1, 60)} | {bytes([i]) for i in range(256)} | {b"ab" * 150, b"the" * 90})
    sizes, ids = bpe.Folder(ranks).fold(words)
    at = np.concatenate([[0], np.cumsum(sizes)])
    got = [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    assert got == [bpe.fold_word(w, ranks) for w in words]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == [enc._encode_single_piece(w) for w in words]
    df = spark.createDataFrame([(i, list(w)) for i, w in enumerate(words)], "i int, w array<int>")
    assert dict(df.select("i", bpe.merge_fold(df.w, ranks)).collect()) == dict(enumerate(got))
    assert [x.tolist() for x in bpe.Folder(ranks).fold([])] == [[], []]


def test_batches_equal_the_library_whatever_is_remembered():
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    coder = bpe._word_coder(RANKS, P.PATTERN)
    coder._pool._limit = 50
    texts = [t for _, t in odd_rows(seed=3, more=200)]
    for at in range(0, len(texts), 7):
        part = texts[at:at + 7]
        sizes, ids = coder.code(pa.array(part, pa.string()))
        ends = np.cumsum(sizes)
        assert [ids[b - n:b].tolist() for n, b in zip(sizes, ends, strict=True)] == [enc.encode_ordinary(t or "") for t in part]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("limit", [1, 50, 10**6])
def test_tokenizer_batches_equal_the_library_whatever_is_remembered(file, limit):
    """Words of cut pieces are taken from what earlier batches left, in every case and beside marks, digits and far letters."""
    want = library_ids(file, 1)
    _tokens._CODERS.clear()
    texts = [t for _, t in odd_rows(seed=5, more=200)]
    texts += ["The cat's hat, the CAT. (cat) cat7 café, \u0130stanbul's e\u0301t\u00e9 ɐb", "cat hat the istanbul", "cat, hat; the-istanbul i\u0307", "", None]
    for part in [texts[at:at + 9] for at in range(0, len(texts), 9)] + [texts[-5:], texts]:
        assert ids_of(P.path(file), pa.array(part, pa.string()), 1, limit) == [want(t).tobytes() for t in part]


def test_a_worker_remembers_each_piece_once():
    """Pieces with marks or digits took twice the memory: they and their words were both held."""
    path = P.path("byte_bpe_50k.json")
    ids_of(path, pa.array(["warm"]), 1)
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = pa.array([" ".join(f"{i * 100 + j:06}".translate(letters) + "," for j in range(100)) for i in range(500)])
    tracemalloc.start()
    try:
        ids_of(path, texts, 1)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 220 * 50_000


def test_marks_beside_a_word_make_no_new_piece():
    """Each word with a mark, an accent or a line's end beside it was cut and looked up on its own: most of op4's time."""
    for file, digits in (("byte_bpe_50k.json", [" 42"]), ("word_bpe_49k.json", [" 4", "2"])):
        _tokens._CODERS.clear()
        ids_of(P.path(file), pa.array(["a cat, (a cat) a cat. a cat!\nété a été, 42 42", None, "a été."]), 1)
        held = _tokens.coder(P.path(file))._pool._at
        assert set(held) == {"a", " a", " cat", " (", ",", ")", ".", "!", "\n", "été", " été", *digits}


@pytest.mark.parametrize("alone", [False, True])
def test_pieces_cut_by_kinds_join_to_the_texts(alone):
    texts = [t for _, t in odd_rows(seed=7, more=200)] + ["", None, "it's 2², 10×3 \n\nİstanbul ɐ— 中文.end\n", "\n", " ", "x "]
    per_text, numbers, keys = _tokens.cut_by_kinds(pa.array([*texts, "cut off"], pa.string()).fill_null("").slice(0, len(texts)), alone)
    pieces = [keys[i] for i in numbers]
    ends = np.cumsum(per_text)
    assert ["".join(pieces[b - n:b]) for n, b in zip(per_text, ends, strict=True)] == [t or "" for t in texts]
    assert all(pieces) and len(set(keys)) == len(keys)
    empty = _tokens.cut_by_kinds(pa.array(["", ""]), alone)
    assert [len(x) for x in empty] == [2, 0, 0] and not empty[0].any()


def random_texts(seed, n):
    import random

    rnd = random.Random(seed)
    usual = [*"aZtés 77.,;!\n-", *[" "] * 6, "word", "The", "É", "ß", "12", "...", "×"]
    odd = [*"'`~@[/²ªµ½÷ÿıİſǅǃɏɐʰΩς中😀’—️٣ẞȺÅ", "'s", "'ll", "\n\n", "\r\n", "\t", " \n", "\0", "\x1c", "\x7f", "\x85", "\xa0", "\u0301", "\u2009", "\ufeff"]
    return ["".join(rnd.choice(rnd.choice((usual, usual, odd))) for _ in range(rnd.choice((1, 3, 12, 80)))) for _ in range(n)]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_random_texts_equal_the_library(file):
    want, texts = library_ids(file, 1), random_texts(11, 600)
    _tokens._CODERS.clear()
    for at in range(0, len(texts), 40):
        part = texts[at:at + 40]
        assert ids_of(P.path(file), pa.array(part), 1, 300) == [want(t).tobytes() for t in part]


@pytest.mark.parametrize("unknown", [None, "a"])
def test_a_vocabulary_without_some_bytes_equals_the_library(tmp_path, unknown):
    """The model leaves out a byte that has no id, or gives it the unknown token's: then ids are not told apart by their widths."""
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        told = json.load(f)
    vocab = {t: i for t, i in told["model"]["vocab"].items() if "z" not in t}
    told["model"] |= {"vocab": vocab, "merges": [m for m in told["model"]["merges"] if "z" not in "".join(m)], "unk_token": unknown}
    path = tmp_path / "some.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    tok, texts = Tokenizer.from_file(str(path)), ["a zoo, the pizza. zz z", "no such byte here", "zzz"]
    assert ids_of(str(path), pa.array(texts)) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_a_full_memory_keeps_what_was_met_again():
    made = []

    def make(keys):
        made.extend(keys)
        return np.array([len(k) for k in keys]), np.array([ord(c) for k in keys for c in k], np.uint32)

    pool = _batch.Pool(4)
    for keys in (["the", "a"], ["the", "x", "y", "z"], ["the", "a", "q"]):
        sizes, ids = pool.rows(pool.places(keys, make))
        assert sizes.tolist() == [len(k) for k in keys] and "".join(map(chr, ids)) == "".join(keys)
    assert made == ["the", "a", "x", "y", "z", "a", "q"]   # only "the" was met again before the memory was full


def test_other_operators_let_the_vocabulary_go():
    path = P.path("byte_bpe_50k.json")
    ids_of(path, pa.array(["a text"]), 1)
    _tokens.start_task()
    assert path in _tokens._CODERS   # kept between the tasks of its own operators
    _io.let_go()
    assert not _tokens._CODERS


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_are_matched_as_the_library_does(file):
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "<|EndOfText|> x", None, "plain  text"]
    want = library_ids(file, 1)
    assert ids_of(P.path(file), pa.array(texts, pa.string()), 1) == [want(t).tobytes() for t in texts]


def test_op6_large_ids_stay_exact_beside_a_null(spark):
    ids = [None, 2**60 + 1, 2**60 + 3, 2**53 + 1]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").coalesce(1)
    assert Counter(r.doc_id for r in packing.pack(docs, P.path("word_bpe_49k.json"), 1).collect()) == Counter(ids)


def test_op1_decode_of_unknown_ids_is_null(spark, no_docs):
    df = spark.createDataFrame([([0, 1],), ([99_999_999],), (None,), ([],)], "ids array<int>")
    assert [r[1] is None for r in bpe.decode(df, RANKS).collect()] == [False, True, True, False]
    assert bpe.encode(no_docs, RANKS, P.PATTERN).count() == 0


def test_op4_files_hold_the_librarys_ids_in_order(spark, odd_docs, no_docs):
    ids = library_ids("byte_bpe_50k.json", 0)
    folder = new_folder(spark, "files")
    token_files.write(odd_docs, folder, P.path("byte_bpe_50k.json"), 0)
    got = token_files.read(spark, folder).orderBy("start").collect()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    at = 0
    for r, (_, t) in zip(got, rows, strict=True):
        want = ids(t)
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(want), zlib.crc32(want.tobytes()), want.tobytes())
        at += len(want)
    one = token_files.fetch(spark, folder, [9]).collect()
    assert [list(r.ids) for r in one] == [ids(odd_rows()[9][1]).tolist()] * 2  # row 9 is there twice
    empty = new_folder(spark, "none")
    token_files.write(no_docs, empty, P.path("byte_bpe_50k.json"), 0)
    assert token_files.read(spark, empty).count() == 0


def test_op4_other_dictionary_is_refused(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(40)], "doc_id long, text string")
    folder = new_folder(spark, "files")
    token_files.write(docs, folder, P.path("byte_bpe_50k.json"), 0)
    other = spark.read.parquet(f"{folder}/dictionary").selectExpr("'00' AS dict_hash", "dictionary")
    other.write.mode("append").parquet(f"{folder}/dictionary_2")
    assert token_files.read(spark, folder).count() == 40
    moved = new_folder(spark, "moved")
    spark.read.parquet(f"{folder}/blocks").write.parquet(f"{moved}/blocks")
    spark.read.parquet(f"{folder}/dictionary_2").write.parquet(f"{moved}/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        token_files.read(spark, moved).collect()


def test_op6_pieces_hold_every_id_once(spark, odd_docs, no_docs):
    ids = library_ids("word_bpe_49k.json", 1)
    path = P.path("word_bpe_49k.json")
    got = packing.pack(odd_docs, path, 1, window=256, open_windows=4, least_piece=8)
    rows = got.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    copies = Counter(i for i, _ in odd_rows())
    for i, t in dict(odd_rows()).items():
        want = ids(t)
        assert sorted(x for r in by_doc[i] for x in range(r.start, r.start + r.length)) == sorted([*range(len(want))] * copies[i])
        for r in by_doc[i]:
            part = want[r.start:r.start + r.length].tobytes()
            assert (r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (len(want), zlib.crc32(part), part)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    p = packing.padding(got, 256).first()
    assert p.sequences == len(by_sequence) and p.padding <= 256 + 0.02 * p.tokens
    assert packing.pack(no_docs, path, 1).count() == 0
