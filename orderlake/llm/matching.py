"""Operator 12: the probability of whole texts by prediction with partial matching over byte contexts.

The trie is kept as tables: for each order k, the byte contexts of k symbols
with the symbols that follow them in the training texts and how often. They
hold every training text (no cap on contexts or counts) and so grow with the
corpus; no task and no driver holds them whole.

A symbol's probability is looked up in its longest known context and, where
the symbol is new there, in ever shorter ones:

* *Escape estimation (method C).* In a context with n observations of q
  symbols, a symbol seen c times has c / (n + q), and "none of them" q / (n + q).
* *Symbol exclusion.* After an escape, the symbols of the longer context cannot
  come, so their counts are taken out of the shorter context's n and q. A longer
  context's symbols are always among the shorter one's, so what is to be taken
  out is one number per context, which a join of two orders gives.
* Below order 0, all symbols that are left are equally likely. Symbols are the
  256 byte values and the end of the text, so the probabilities of all texts
  add up to 1.

Documents are cut into blocks. A block asks for the costs of its distinct
(context, symbol) pairs and the counts of its distinct words; the answers come
back through a shuffle by block and meet the block's texts (zstandard chunks)
there. A block holds a bounded number of characters, so no group of documents
or texts, however common, makes a large one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import prepare, stage
from orderlake.llm.resampling import numbered_words

#: Bytes of the longest context.
ORDER = 4
#: Symbols as digits: 0 stands before a text's first byte, 1 to 256 are the byte values, 257 is the end.
BASE, END = 258, 257
#: Symbols that can follow a context.
ALPHABET = 257
#: What stands between the words of the base score.
SPACES = r"[\x20\x09-\x0D]+"
#: The base score's additive constant.
ADD = 0.1
#: UTF-8 bytes after which a chunk of texts is closed; bytes, and distinct pairs and words, after which a block is.
CHUNK_BYTES, BLOCK_BYTES, BLOCK_KEYS = 1_000_000, 32_000_000, 2_000_000


def word_keys(words: list[bytes]) -> np.ndarray:
    """Negative 63-bit hashes, so that they differ from all pairs. (Two of a billion words share one with a chance of a twentieth.)"""
    import xxhash

    return -(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)).astype(np.int64) - 1


def pair_codes(texts: list[bytes], order: int) -> np.ndarray:
    """For all symbols of all texts in turn, ends included: the ``order`` symbols before it and itself as one number."""
    symbols = np.zeros(sum(map(len, texts)) + (order + 1) * len(texts), np.int64)
    at = 0
    for t in texts:
        symbols[at + order:at + order + len(t)] = np.frombuffer(t, np.uint8)
        symbols[at + order:at + order + len(t)] += 1
        at += order + len(t) + 1
        symbols[at - 1] = END
    n = len(symbols) - order
    code = np.zeros(max(0, n), np.int64)
    for j in range(order + 1):
        code *= BASE
        code += symbols[j:n + j]
    return code[symbols[order:] != 0]


class _Chunk:
    """Documents' texts, as pairs and words."""

    def __init__(self, texts: list[bytes], order: int):
        self.codes = pair_codes(texts, order)
        self.symbols = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        at, self.words, spelled = numbered_words(pa.array(texts, pa.binary()).cast(pa.string()), SPACES)
        self.n_words, self.keys = np.diff(at), word_keys(spelled)


class _Tally:
    """Distinct keys, ascending, and how often each occurs in learned documents (0: only in others)."""

    def __init__(self):
        self.keys, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, learned: np.ndarray) -> None:
        own, times = np.unique(keys[learned], return_counts=True)
        every = np.concatenate([self.keys, own, np.unique(keys[~learned])])
        self.keys, place = np.unique(every, return_inverse=True)
        counted = np.concatenate([self.times, times, np.zeros(len(every) - len(self.times) - len(times), np.int64)])
        self.times = np.bincount(place, counted, len(self.keys)).astype(np.int64)


def _cut(docs: DataFrame, learn: Column, order: int, id_col: str, text_col: str) -> DataFrame:
    """Chunk rows (block, ids, learned, sizes, packed) and key rows (block, key, times), written once so that blocks stay what they are."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(to_arrow_type(kind))), ("learned", pa.list_(pa.bool_())),
                        ("sizes", pa.list_(pa.int64())), ("packed", pa.binary()), ("key", pa.int64()), ("times", pa.int64())])
    end = word_keys([b""])

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        press = zstandard.ZstdCompressor(level=3)
        block, tally, block_bytes = TaskContext.get().partitionId() << 32, _Tally(), 0
        ids, learned, texts, held = [], [], [], 0

        def chunk():
            taken = _Chunk(texts, order)
            picked = np.array(learned, bool)
            tally.add(taken.codes, np.repeat(picked, taken.symbols))
            tally.add(np.concatenate([taken.keys[taken.words], np.repeat(end, len(texts))]), np.concatenate([np.repeat(picked, taken.n_words), picked]))
            cells = [[block], [ids], [learned], [[len(t) for t in texts]], [press.compress(b"".join(texts))], [None], [None]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema, strict=True)], schema=schema)

        def keys():
            n = len(tally.keys)
            cells = [pa.array(np.full(n, block)), *(pa.nulls(n, f.type) for f in schema if f.name in ("ids", "learned", "sizes", "packed")),
                     pa.array(tally.keys), pa.array(tally.times)]
            return pa.RecordBatch.from_arrays(cells, schema=schema)

        for batch in batches:
            for key, picked, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(key), learned.append(picked), texts.append(text or b"")
                held += len(texts[-1]) + 1
                if held >= CHUNK_BYTES:
                    yield chunk()
                    block_bytes += held
                    ids, learned, texts, held = [], [], [], 0
                    if block_bytes >= BLOCK_BYTES or len(tally.keys) >= BLOCK_KEYS:
                        yield keys()
                        block, tally, block_bytes = block + 1, _Tally(), 0
        if texts:
            yield chunk()
        if len(tally.keys):
            yield keys()

    name = kind.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learned"), F.col(text_col).alias("text")).mapInArrow(
        run, f"block bigint, ids array<{name}>, learned array<boolean>, sizes array<bigint>, packed binary, key bigint, times bigint")
    return stage(rows, "cut")


def contexts(pairs: DataFrame, order: int) -> list[tuple[DataFrame, DataFrame]]:
    """For each order k from 0: (code, c) of its pairs, and (ctx, n, q, taken) of its contexts.

    ``pairs`` (code, c) are those of the highest order. ``taken`` is what the
    context's symbols count in the context that is one symbol shorter.
    """
    out = []
    for k in range(order, -1, -1):
        own = stage(pairs if k == order else pairs.groupBy((F.col("code") % BASE ** (k + 1)).alias("code")).agg(F.sum("c").alias("c")), f"pairs{k}")
        out.insert(0, own)
        pairs = own
    told = []
    for k, own in enumerate(out):
        seen = own
        if k:
            shorter = out[k - 1].select(F.col("code").alias("below"), F.col("c").alias("c_below"))
            seen = own.join(_hint(shorter, k - 1), F.col("code") % BASE**k == F.col("below"))
        taken = F.sum("c_below") if k else F.lit(0).cast("bigint")
        ctx = F.expr(f"code div {BASE}")
        told.append((own, stage(seen.groupBy(ctx.alias("ctx")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("q"), taken.alias("taken")), f"contexts{k}")))
    return told


def _hint(df: DataFrame, k: int) -> DataFrame:
    """Pairs and contexts of the orders 0 and 1 have at most BASE ** 2 (66,564) rows; all others are left to the planner."""
    return F.broadcast(df) if k <= 1 else df


def costs(asked: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(key, value): the log10 probability of each of the pairs ``asked`` (key), order by order from the longest context down."""
    zero = F.lit(0).cast("bigint")
    left = asked.select("key", F.lit(0.0).alias("lp"), zero.alias("out_n"), zero.alias("out_q"))
    found = None
    for k in range(len(levels) - 1, -1, -1):
        pairs, nodes = levels[k]
        code = F.col("key") % BASE ** (k + 1)
        met = left.join(_hint(pairs, k), code == F.col("code"), "left").join(_hint(nodes, k), F.expr(f"(key % {BASE ** (k + 1)}) div {BASE}") == F.col("ctx"), "left")
        new_q = F.col("q") - F.col("out_q")
        total = (F.col("n") - F.col("out_n") + F.when(F.col("q") < ALPHABET, new_q).otherwise(0)).cast("double")
        escape = F.when(new_q > 0, F.log10(new_q / total)).otherwise(0.0)
        known = F.col("ctx").isNotNull()
        met = stage(met.select(
            "key", (F.col("lp") + F.coalesce(F.log10(F.col("c") / total), F.when(known, escape).otherwise(0.0))).alias("lp"),
            F.col("c").isNotNull().alias("done"), F.when(known, F.col("taken")).otherwise(zero).alias("out_n"),
            F.when(known, F.col("q")).otherwise(zero).alias("out_q")), f"costs{k}")
        done = met.filter("done").select("key", F.col("lp").alias("value"))
        found = done if found is None else found.unionByName(done)
        left = met.filter("not done").drop("done")
    return found.unionByName(left.select("key", (F.col("lp") - F.log10((ALPHABET - F.col("out_q")).cast("double"))).alias("value")))


def score(docs: DataFrame, learn: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, learned, n_tokens, n_known, train_tokens, base_score and score.

    The rows that ``learn`` picks (null: not picked) are learned from; all are
    scored. ``score`` is the log10 probability of the whole text's UTF-8 bytes
    and its end. ``base_score`` is that of its tokens (words between blanks, A-Z
    lower-cased, and an end) with additive smoothing; ``n_known`` of its
    ``n_tokens`` occur among the ``train_tokens`` learned. A null text is an
    empty one: its end alone. Null and repeated ids pass through, row by row;
    other columns are not read. Texts of any length; an empty table gives no
    rows. With nothing learned, all symbols are equally likely.
    """
    if not 0 <= order <= 6:
        raise ValueError("a context has 0 to 6 bytes")
    prepare(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type

    cut = _cut(docs, learn, order, id_col, text_col)
    asked = cut.filter("key is not null").select("block", "key", "times")
    counts = stage(asked.groupBy("key").agg(F.sum("times").alias("c")), "counts")
    words = counts.filter("key < 0 and c > 0")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    levels = contexts(counts.filter("key >= 0 and c > 0").select(F.col("key").alias("code"), "c"), order)
    values = costs(counts.filter("key >= 0").select("key"), levels).unionByName(words.select("key", F.col("c").cast("double").alias("value")))
    answers = asked.select(F.col("block").alias("asker"), "key").join(values, "key").select("asker", "key", "value")

    kind = docs.schema[id_col].dataType
    schema = pa.schema([(id_col, to_arrow_type(kind)), ("learned", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    end, floor = word_keys([b""]), math.log10(n + ADD * (v + 1))

    def run(chunks: pa.Table, told: pa.Table) -> pa.Table:
        import zstandard

        index, value = pd.Index(told["key"].to_numpy()), told["value"].to_numpy()
        unpress, out = zstandard.ZstdDecompressor(), []
        times = np.append(value, 0.0)  # a word that is not there has place -1
        ends = times[index.get_indexer(end)][0]
        for row in range(chunks.num_rows):
            sizes = np.asarray(chunks["sizes"][row].values, np.int64)
            whole = unpress.decompress(chunks["packed"][row].as_py(), max_output_size=max(1, int(sizes.sum())))
            at = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            taken = _Chunk([whole[a:b] for a, b in zip(at, at[1:], strict=False)], order)
            place = index.get_indexer(taken.codes)
            if (place < 0).any():
                raise ValueError("a block lacks costs of its own pairs")
            docs_of = np.arange(len(sizes))
            total = np.bincount(np.repeat(docs_of, taken.symbols), value[place], len(sizes))
            c, owner = times[index.get_indexer(taken.keys)][taken.words], np.repeat(docs_of, taken.n_words)
            known = np.bincount(owner, c > 0, len(sizes)).astype(np.int64) + int(ends > 0)
            base = np.bincount(owner, np.log10(c + ADD), len(sizes)) + math.log10(ends + ADD) - floor * (taken.n_words + 1)
            out.append(pa.Table.from_arrays([
                chunks["ids"][row].values, chunks["learned"][row].values, pa.array(taken.n_words + 1), pa.array(known),
                pa.array(np.full(len(sizes), n, np.int64)), pa.array(base), pa.array(total)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    chunks = cut.filter("packed is not null").select("block", "ids", "learned", "sizes", "packed")
    return chunks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        run, f"`{id_col}` {kind.simpleString()}, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
