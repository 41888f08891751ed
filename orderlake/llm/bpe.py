"""Operator 1: byte-level BPE encoding and decoding.

Ranked merges are folded over the byte arrays of distinct words with a literal
rank map, in one of two styles that give the same ids:

``spark``
    Python cuts blocks of documents into words and numbers a block's distinct
    words; ``transform`` over those words folds the merges (``aggregate``). The
    ranks stand in literal arrays, so a lookup takes constant time.
``task`` (default)
    The same fold runs inside the Arrow task that cuts the words, over arrays
    of all distinct words that the task's worker has not met: each round merges
    the lowest-ranked pair of every word. Spark interprets lambda bodies node
    by node, which costs over ten times as much a word (README).

Nothing is shuffled and nothing grows with the corpus but the rows themselves.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import KEPT, free_name, let_go, prepare
from orderlake.llm._batch import BatchCoder, gathered, regroup, spread
from orderlake.llm._text import PieceCache, is_word, space_chunks
from orderlake.llm._tokens import BYTE_LEVEL_SPLIT

NONE = 2**31 - 1
#: Ranks are below this.
LARGEST = 1 << 16
#: Characters after which a block of documents ends; a task holds one block.
BLOCK_CHARS = 24_000_000
#: Ids after which an output batch ends.
BATCH_IDS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a base64 piece and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _prime_from(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def pair_table(ranks: dict[bytes, int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two tables (pairs, ranks): the pair (a, b) as a * 65536 + b stands at its remainder by the length of one of them, if it has a rank.

    A newcomer pushes out what holds its place, which moves to its place in
    the other table; if that does not end, both are made longer.
    """
    if len(ranks) > LARGEST or max(ranks.values(), default=0) >= LARGEST:
        raise ValueError("at most 65,536 ranks")
    pairs = [(ranks[p[:i]] << 16 | ranks[p[i:]], r) for p, r in ranks.items() for i in range(1, len(p))
             if p[:i] in ranks and p[i:] in ranks]
    size = max(11, len(pairs))
    while True:
        sizes = [_prime_from(size)]
        sizes.append(_prime_from(sizes[0] + 2))
        tables = [[(-1, 0)] * s for s in sizes]
        for entry in pairs:
            for turn in range(500):
                table = tables[turn % 2]
                at = entry[0] % len(table)
                entry, table[at] = table[at], entry
                if entry[0] < 0:
                    break
            else:
                break
        else:
            return [tuple(np.array(t, np.int64).T) for t in tables]
        size = size * 5 // 4


def _numbers(values: list[int], kind: str = "int") -> Column:
    """A literal array; written as text, because Spark folds this cast into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merge_fold(word: Column, ranks: dict[bytes, int]) -> Column:
    """array<int> of byte values -> array<int> of token ids: the lowest-ranked pair, leftmost first, merges until none has a rank.

    The fold's state is one number a piece: the rank of it and its right
    neighbour, the place where it begins, and its id. The least number is the
    pair to merge.
    """
    tables = [(_numbers(pairs.tolist(), "bigint"), _numbers(told.tolist()), len(pairs)) for pairs, told in pair_table(ranks)]
    byte_ids = _numbers([ranks[bytes([b])] for b in range(256)])
    one = lambda n: F.lit(n).cast("bigint")
    unit, place = 1 << 46, 1 << 16

    def rank(a: Column, b: Column) -> Column:
        pair, found = a.cast("bigint") * one(place) + b, F
        for pairs, told, n in tables:
            at = (pair % n).cast("int")
            found = found.when(F.get(pairs, at) == pair, F.get(told, at))
        return found.otherwise(F.lit(LARGEST)).cast("bigint")

    def token(item: Column) -> Column:
        return item.bitwiseAND(one(place - 1)).cast("int")

    def merge(items: Column, low: Column, at: Column) -> Column:
        new = F.shiftright(low, 46).cast("int")
        after, before = F.get(items, at + 1), F.get(items, at - 2)
        grown = rank(new, token(after)) * one(unit) + low.bitwiseAND(one(unit - place)) + new
        rest = F.slice(items, at + 2, F.size(items))
        left = rank(token(before), new) * one(unit) + before.bitwiseAND(one(unit - 1))
        return F.when(at > 1, F.concat(F.slice(items, F.lit(1), at - 2), F.array(left, grown), rest)).otherwise(F.concat(F.array(grown), rest))

    def step(items: Column, _) -> Column:
        return _let(F.array_min(items), lambda low: F.when(low >= one(LARGEST * unit), items).otherwise(
            _let(F.array_position(items, low).cast("int"), lambda at: merge(items, low, at))))

    def start(ids: Column) -> Column:
        return F.transform(ids, lambda a, i: rank(a, F.get(ids, i + 1)) * one(unit) + i.cast("bigint") * one(place) + a)

    letters = F.transform(word, lambda b: F.get(byte_ids, b))
    rounds = F.when(F.size(word) > 1, F.sequence(F.lit(2), F.size(word))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, _let(letters, start), step, lambda items: F.transform(items, token))


class Folder:
    """The same fold over many words at once: each round merges one pair of every word that still has one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self._tables = ranks, pair_table(ranks)
        self._byte_ids = np.array([ranks[bytes([b])] for b in range(256)])

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair, rank = a << 16 | b, np.full(len(a), NONE)
        for pairs, told in self._tables:
            at = pair % len(pairs)
            rank = np.where(pairs[at] == pair, told[at], rank)
        return rank

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids in turn). Words are not empty; long ones are folded with a heap."""
        known = [[self.ranks[w]] if w in self.ranks else fold_word(w, self.ranks) if len(w) >= 200 else None for w in words]
        open_words = [i for i, k in enumerate(known) if k is None]
        sizes = np.array([len(k) if k else 0 for k in known], np.int64)
        done = [(np.array([i for i, k in enumerate(known) if k], np.int64), np.array([x for k in known if k for x in k], np.int64))]
        number = np.array(open_words, np.int64)
        length = np.array([len(words[i]) for i in open_words], np.int64)
        ids = self._byte_ids[np.frombuffer(b"".join(words[i] for i in open_words), np.uint8)]
        rank = np.full(len(ids), NONE)
        rank[:-1] = self._pair(ids[:-1], ids[1:])
        rank[np.cumsum(length) - 1] = NONE   # no pair goes on into the next word
        while len(number):
            start = np.cumsum(length) - length
            low = np.minimum.reduceat(rank, start)
            live = low != NONE
            if live.sum() <= 0.7 * len(live):   # words without a pair leave
                stays = np.repeat(live, length)
                done.append((number[~live], ids[~stays]))
                sizes[number[~live]] = length[~live]
                number, length, ids, rank, low = number[live], length[live], ids[stays], rank[stays], low[live]
                if not len(number):
                    break
                start = np.cumsum(length) - length
                live = np.ones(len(number), bool)
            hit = np.flatnonzero((rank == np.repeat(low, length)) & (rank != NONE))
            word = np.searchsorted(start, hit, "right") - 1
            leftmost = np.concatenate([[True], word[1:] != word[:-1]])
            hit, word = hit[leftmost], word[leftmost]
            ids[hit] = rank[hit]
            kept = np.ones(len(ids), bool)
            kept[hit + 1] = False
            ids, rank = ids[kept], rank[kept]
            hit -= np.arange(len(hit))
            length[word] -= 1
            start = np.cumsum(length) - length
            last = start[word] + length[word] - 1
            follows = np.minimum(hit + 1, len(ids) - 1)
            rank[hit] = np.where(hit < last, self._pair(ids[hit], ids[follows]), NONE)
            inner = hit > start[word]
            rank[hit[inner] - 1] = self._pair(ids[hit[inner] - 1], ids[hit[inner]])
        out = np.zeros(int(sizes.sum()), np.uint32)
        first = np.cumsum(sizes) - sizes
        for words_of, tokens in done:
            out[spread(first[words_of], sizes[words_of])] = tokens
        return sizes, out


def fold_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word: the lowest-ranked pair, leftmost first, merges until none has a rank.

    A heap holds the ranked pairs as (rank, place of the left piece, piece), so
    a word of n bytes takes O(n log n) steps however long it is.
    """
    n = len(word)
    if word in ranks:
        return [ranks[word]]
    get, piece = ranks.get, [word[i:i + 1] for i in range(n)]
    if n < 200:
        rank = [get(word[i:i + 2], NONE) for i in range(n - 1)]
        while rank and (low := min(rank)) != NONE:
            at = rank.index(low)
            piece[at] = merged = piece[at] + piece.pop(at + 1)
            del rank[at]
            if at < len(rank):
                rank[at] = get(merged + piece[at + 1], NONE)
            if at:
                rank[at - 1] = get(piece[at - 1] + merged, NONE)
        return [ranks[p] for p in piece]
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(ranks[p], i, p) for i in range(n - 1) if (p := word[i:i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, merged = heapq.heappop(heap)
        j = after[i]
        if j < 0 or piece[i] is None or len(piece[i]) + len(piece[j]) != len(merged):
            continue  # one of the two has merged meanwhile
        piece[i], piece[j], after[i] = merged, None, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (p := piece[left] + piece[right]) in ranks:
                heapq.heappush(heap, (ranks[p], left, p))
    return [ranks[p] for p in piece if p is not None]


_CODERS: dict[tuple[str, str], BatchCoder] = {}
KEPT.append(_CODERS)


def _word_coder(rank_path: str, pattern: str) -> BatchCoder:
    """Texts -> ids of their words; what is remembered is kept for each Python worker, between its tasks."""
    if (rank_path, pattern) not in _CODERS:
        import regex

        search, folder, simple = regex.compile(pattern).findall, Folder(read_ranks(rank_path)), pattern == BYTE_LEVEL_SPLIT

        def find(chunk: str) -> list[str]:
            return [chunk] if simple and is_word(chunk) else search(chunk)

        def make(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            numbers: dict[str, int] = {}
            cut = [[numbers.setdefault(w, len(numbers)) for w in find(c)] for c in chunks]
            sizes, ids = folder.fold([w.encode("utf-8", "surrogatepass") for w in numbers])
            used = np.array([n for c in cut for n in c], np.int64)
            return regroup(np.array([len(c) for c in cut], np.int64), sizes[used]), ids[spread((np.cumsum(sizes) - sizes)[used], sizes[used])]

        _CODERS[rank_path, pattern] = BatchCoder(make, lambda text: make([text])[1], limit=600_000)
    return _CODERS[rank_path, pattern]


def _task_encoder(rank_path: str, pattern: str, key_name: str, key_type: pa.DataType):
    schema = pa.schema([(key_name, key_type), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        let_go(_CODERS)
        coder = _word_coder(rank_path, pattern)
        for batch in gathered(batches):
            sizes, ids = coder.code(batch.column(1))
            at, done = np.concatenate([[0], np.cumsum(sizes)]), 0
            while done < batch.num_rows:
                upto = max(done + 1, int(np.searchsorted(at, at[done] + BATCH_IDS, "right")) - 1)
                listed = pa.ListArray.from_arrays(pa.array((at[done:upto + 1] - at[done]).astype(np.int32)), pa.array(ids[at[done]:at[upto]].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, upto - done), listed], schema=schema)
                done = upto

    return run


def _block_cutter(pattern: str, block_chars: int, key_type: pa.DataType):
    """mapInArrow function: documents -> blocks (keys, words of each, number of each word, distinct words as byte arrays)."""

    def cut(batches):
        import regex

        find = regex.compile(pattern).findall
        names = ["keys", "sizes", "refs", "words"]

        def fresh():
            words: dict[str, int] = {}
            return words, PieceCache(lambda c: [words.setdefault(w, len(words)) for w in find(c)], 2**62, 2**62)

        def block():
            spelled = [w.encode("utf-8", "surrogatepass") for w in words]
            at = np.zeros(len(spelled) + 1, np.int32)
            np.cumsum([len(b) for b in spelled], out=at[1:])
            letters = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int32)
            cells = [pa.array(keys, key_type), pa.array(sizes, pa.int32()), pa.array(np.frombuffer(b"".join(refs), np.int32)),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(letters))]
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cells], names)

        (words, cache), keys, sizes, refs, chars = fresh(), [], [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                got = cache.of(space_chunks(text))
                keys.append(key), sizes.append(len(got) // 4), refs.append(got)
                chars += len(text) + 20
                if chars >= block_chars:
                    yield block()
                    (words, cache), keys, sizes, refs, chars = fresh(), [], [], [], 0
        if keys:
            yield block()

    return cut


def _joiner(key_name: str, key_type: pa.DataType):
    """mapInArrow function: encoded blocks -> documents with their ids."""
    schema = pa.schema([(key_name, key_type), ("ids", pa.list_(pa.int32()))])

    def join(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys, sizes, refs, codes = (batch.column(i)[row].values for i in range(4))
                at = np.asarray(codes.offsets, np.int64)
                flat = codes.values.to_numpy(zero_copy_only=False).astype(np.int32)
                starts, lengths = at[:-1], np.diff(at)
                refs = refs.to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
                tokens_until = np.concatenate([[0], np.cumsum(lengths[refs], dtype=np.int64)])
                doc_tokens = np.concatenate([[0], tokens_until[ends]])
                done, n = 0, len(keys)
                while done < n:
                    upto = max(done + 1, int(np.searchsorted(doc_tokens, doc_tokens[done] + BATCH_IDS, "right")) - 1)
                    part = refs[(ends[done - 1] if done else 0):ends[upto - 1]]
                    size = lengths[part]
                    first = np.concatenate([[0], np.cumsum(size)])
                    place = np.repeat(starts[part] - first[:-1], size) + np.arange(first[-1])
                    offsets = (doc_tokens[done:upto + 1] - doc_tokens[done]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[place]))
                    yield pa.RecordBatch.from_arrays([keys.slice(done, upto - done), ids], schema=schema)
                    done = upto

    return join


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           style: str = "task", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(``id_col``, ids array<int>) of every row of ``docs``, as plain byte-level BPE without special tokens gives.

    A null or empty text gives an empty array; null and repeated ids are kept as
    they are, row by row; other columns are not read. Texts and words may be of
    any length. In the style ``spark`` a block ends after ``block_chars``
    characters, so a longer text is a block of its own.
    """
    prepare(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type

    ranks = read_ranks(rank_path)
    kind = docs.schema[id_col].dataType
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    if style == "task":
        return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
            _task_encoder(rank_path, pattern, id_col, arrow), f"`{id_col}` {name}, ids array<int>")
    blocks = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        _block_cutter(pattern, block_chars, arrow),
        f"keys array<{name}>, sizes array<int>, refs array<int>, words array<array<int>>")
    coded = blocks.select("keys", "sizes", "refs", F.transform("words", lambda w: merge_fold(w, ranks)).alias("codes"))
    return coded.mapInArrow(_joiner(id_col, arrow), f"`{id_col}` {name}, ids array<int>")


def decode(tokens: DataFrame, rank_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``out_col``: the bytes of the pieces of ``ids_col``, concatenated.

    Null ids give null, no ids give no bytes; an id outside the vocabulary (or
    a null among the ids) makes the whole result null. If ``tokens`` already
    has a column ``out_col``, underscores are added to the new one's name.
    """
    pieces = {r: p.hex() for p, r in read_ranks(rank_path).items()}
    spelled = F.split(F.lit(",".join(pieces.get(i, "!") for i in range(max(pieces, default=-1) + 1))), ",")   # folded into one literal
    # No hexadecimal text holds "!", so a piece that is not there makes the whole null.
    whole = F.unhex(F.array_join(F.transform(ids_col, lambda i: F.get(spelled, i)), "", "!"))
    return tokens.withColumn(free_name(tokens, out_col), whole)


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, n_tokens, ids_sha256 and decoded_sha256 of a frame with ids and decoded."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(id_col, F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
