"""Operator 8: language identification by cross-parsing.

For each language, a suffix automaton of a bounded sample of labelled text
knows every substring of it. A text is parsed greedily into the longest
phrases that the automaton knows; the language whose automaton needs the
fewest phrases, normalised by the logarithm of its sample's length and the
length of the text, wins. Whole texts are parsed. To advance many places at
once, a text is cut into blocks that are parsed side by side, and then each
block's beginning is parsed again from where the block before ended, until both
parses open a phrase at the same letter: from there on they agree, so the
phrases counted are those of one parse from the text's first letter to its last.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._batch import gathered
from orderlake.llm._io import KEPT, free_name, let_go, prepare

#: Labelled text of a language: a stretch of so many characters, beginning anywhere, of at most so many documents (those with the smallest hashes).
SAMPLE_DOCS, SAMPLE_CHARS = 80, 400
#: Languages that are learned at most; more labels than that are an error.
MOST_LANGUAGES = 1000
#: Characters of a block.
BLOCK = 512
#: Share of its letters that no sample has, above which a text is in none of the languages. (Phrases a character do not tell: they depend on
#: the text's length and the size of the alphabet.)
FOREIGN = 0.5

def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with each run of other characters than letters as one 32."""
    return np.frombuffer("".join(c if c.isalpha() else " " for c in text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Sample:
    """What a model is made of: languages (ascending) and their sample texts."""

    languages: list[str]
    texts: list[str]


class _Steps:
    """(state, letter) -> next state or -1, in an open-addressed table that arrays of keys are looked up in at once."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        self._mask = (1 << max(4, (4 * len(keys)).bit_length())) - 1
        self._keys, self._to = np.full(self._mask + 1, -1, np.int64), np.full(self._mask + 1, -1, np.int32)
        at = self._place(keys)
        while len(keys):   # all that found their place free and came first there stay; the others try the next one
            free = self._keys[at] < 0
            _, first = np.unique(at, return_index=True)
            wins = np.zeros(len(keys), bool)
            wins[first] = True
            wins &= free
            self._keys[at[wins]], self._to[at[wins]] = keys[wins], to[wins]
            keys, to, at = keys[~wins], to[~wins], (at[~wins] + 1) & self._mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(29)) & np.uint64(self._mask)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        shape, keys = keys.shape, keys.ravel()
        at = self._place(keys)
        held = self._keys[at]
        out = np.where(held == keys, self._to[at], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self._mask
            held = self._keys[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self._to[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out.reshape(shape)


class Parser:
    """The automata of a sample: every letter of the samples has its own code, and one code stands for all others."""

    def __init__(self, sample: Sample):
        self.sample = sample
        own = np.unique(np.concatenate([np.array([32], np.uint32), *[_letters(t) for t in sample.texts]]))
        own = own[own != 32]
        self.width = len(own) + 2
        codes = np.zeros(0x110000, np.int32)  # 0: no letter
        every = np.frombuffer("".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])).encode("utf-32-le"), np.uint32)
        codes[every] = [c.isalpha() for c in map(chr, every.tolist())]
        codes[codes == 1] = self.width - 1  # a letter that no sample has
        codes[own] = np.arange(1, len(own) + 1)
        self.codes = codes
        keys, to, self.roots, at = [], [], [], 0
        self.from_root = np.zeros((len(sample.texts), self.width), np.int64)
        for k, text in enumerate(sample.texts):
            steps = _suffix_automaton(self.coded(text).tolist())
            for s, step in enumerate(steps):
                for c, t in step.items():
                    keys.append((at + s) * self.width + c), to.append(at + t)
            self.from_root[k] = at + len(steps)  # a letter that the sample lacks leads to a state without a way on
            for c, t in steps[0].items():
                self.from_root[k, c] = at + t
            self.roots.append(at)
            at += len(steps) + 1
        self.steps = _Steps(np.array(keys, np.int64), np.array(to, np.int32))
        self.cost = np.array([math.log2(max(2, len(self.coded(t)))) for t in sample.texts])

    def coded(self, text: str) -> np.ndarray:
        c = self.codes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        return c[(c != 0) | (np.concatenate([[1], c[:-1]]) != 0)]

    def strange(self, text: str) -> float:
        """Share of the text's letters that no sample has; 0 where it has no letter."""
        c = self.codes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        c = c[c != 0]
        return float((c == self.width - 1).mean()) if len(c) else 0.0

    def _advance(self, state: np.ndarray, letter: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, whether the letter opened a phrase)."""
        to = self.steps.get(state * self.width + letter)
        opened = to < 0
        return np.where(opened, self.from_root[language, letter], to), opened

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: phrases in each language, characters parsed, whether it has a letter."""
        coded = [self.coded(t) for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        letters = np.array([bool((c != 0).any()) for c in coded], bool)
        n, total = len(self.roots), np.zeros((len(self.roots), len(texts)), np.int64)
        pieces = [(i, b, c[b:b + BLOCK]) for i, c in enumerate(coded) for b in range(0, len(c), BLOCK)]
        if not pieces or not n:
            return total, size, letters
        pieces.sort(key=lambda p: -len(p[2]))
        lengths = np.array([len(p) for _, _, p in pieces])
        grid = np.zeros((BLOCK, len(pieces)), np.int32)
        for j, (_, _, p) in enumerate(pieces):
            grid[:len(p), j] = p
        language = np.arange(n)[:, None]
        # Each block from a phrase that begins at its first letter.
        opens = np.zeros((n, BLOCK, len(pieces)), bool)
        last = np.zeros((n, len(pieces)), np.int64)
        state = np.repeat(np.array(self.roots)[:, None], len(pieces), 1)
        for t in range(int(lengths[0])):
            live = int(np.searchsorted(-lengths, -t, "left"))  # blocks longer than t come first
            state[:, :live], opened = self._advance(state[:, :live], grid[t, :live][None], language)
            opens[:, t, :live] = opened
            if t == 0:
                opens[:, 0, :live] = True
                state[:, :live] = self.from_root[language, grid[0, :live][None]]
            ending = np.flatnonzero(lengths[:live] == t + 1)
            last[:, ending] = state[:, ending]
        # Then what the block before leaves open, until both parses open a phrase at one letter.
        place = {(i, b): j for j, (i, b, _) in enumerate(pieces)}
        after = np.array([place.get((i, b + BLOCK), -1) for i, b, _ in pieces])
        before = np.full(len(pieces), -1)
        before[after[after >= 0]] = np.flatnonzero(after >= 0)
        true_last, more = last.copy(), np.zeros((n, len(pieces)), np.int64)
        lang, lane = (x.ravel() for x in np.meshgrid(np.arange(n), np.flatnonzero(before >= 0), indexing="ij"))
        while len(lane):   # again for the blocks after one whose parses did not meet, which is rare
            more[lang, lane] = 0
            state, t, moved = true_last[lang, before[lane]], 0, []
            while len(lane):
                state, opened = self._advance(state, grid[t, lane], lang)
                theirs = opens[lang, t, lane]
                more[lang, lane] += opened.astype(np.int64) - theirs
                agree, done = opened & theirs, lengths[lane] == t + 1
                ends = np.where(agree, last[lang, lane], state)
                new = (agree | done) & (ends != true_last[lang, lane])
                true_last[lang[new], lane[new]] = ends[new]
                moved.append((lang[new], lane[new]))
                goes_on = ~agree & ~done
                lang, lane, state, t = lang[goes_on], lane[goes_on], state[goes_on], t + 1
            lang, lane = (np.concatenate(x) for x in zip(*moved, strict=True))
            lang, lane = lang[after[lane] >= 0], after[lane][after[lane] >= 0]
        count = opens.sum(1) + more
        owner = np.array([i for i, _, _ in pieces])
        for k in range(n):
            total[k] = np.bincount(owner, count[k], len(texts)).astype(np.int64)
        return total, size, letters


def _suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that knows every substring of ``text``; state 0 is the empty one."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q])), link.append(link[q]), length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Sample:
    """The sample of the documents that ``learn`` picks and whose ``lang_col`` and text are not null.

    SAMPLE_DOCS documents of each language, a stretch of SAMPLE_CHARS
    characters of each that begins where the text's hash tells, joined in the
    order of their hashes; few enough for the driver. The documents of all
    languages are chosen in one pass, a bounded list of hashes for each.
    """
    told = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), learn.alias("learn")).filter(
        "learn and lang is not null and text is not null")
    mark = F.xxhash64("id", "text")
    marked = told.select("lang", mark.alias("mark"))
    # The SAMPLE_DOCS smallest hashes of a language lie below its (SAMPLE_DOCS / its rows) quantile: a few times as many are ranked, never all.
    sizes = {r["lang"]: r["n"] for r in marked.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    if not sizes:
        return Sample([], [])
    near = F.lit(False)
    for lang, n in sizes.items():
        share = min(1.0, (SAMPLE_DOCS + 8 * math.sqrt(SAMPLE_DOCS) + 40) / n)
        near = near | ((F.col("lang") == lang) & (F.col("mark") <= F.lit(int(-2**63 + share * (2**64 - 1)) if share < 1 else 2**63 - 1)))
    length = F.length("text")
    start = F.pmod(F.xxhash64("text", F.lit("start")), F.greatest(length - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    piece = F.substring("text", start, F.lit(SAMPLE_CHARS))
    some = told.withColumn("mark", mark).filter(near).select("lang", "mark", piece.alias("piece")).distinct()
    order = Window.partitionBy("lang").orderBy("mark", "piece")   # some hundred short rows of each language
    rows = some.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_DOCS).collect()
    languages = sorted(sizes)
    return Sample(languages, [" ".join(r.piece for r in sorted((r for r in rows if r.lang == lang), key=lambda r: r.place)) for lang in languages])


_PARSERS: dict[int, Parser] = {}
KEPT.append(_PARSERS)


def predict(docs: DataFrame, sample: Sample, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score",
            rate_out: str = "phrase_rate", strange_out: str | None = None) -> DataFrame:
    """``docs`` with the predicted language, its score and the phrases a character it needs (underscores added to names that are taken).

    The score is the runner-up's share of the two normalised phrase counts: 0.5
    for a tie (the alphabetically first language wins), towards 1 the clearer
    (1 where one language was learned). Texts that are null or have no letter,
    and all texts where no language was learned, get ``und``, score 0 and a
    null rate. ``strange_out`` names a further column, if given: the share of
    the text's letters that no sample has.
    """
    prepare(docs.sparkSession)
    names = [free_name(docs, c) for c in (lang_out, score_out, rate_out, strange_out) if c is not None]
    shared = docs.sparkSession.sparkContext.broadcast(sample)
    mark = hash((tuple(sample.languages), tuple(sample.texts)))

    def run(batches):
        let_go(_PARSERS)
        if mark not in _PARSERS:  # kept between a worker's tasks
            _PARSERS.clear()
            _PARSERS[mark] = Parser(shared.value)
        parser, told = _PARSERS[mark], shared.value.languages
        for batch in gathered(batches, 4_000_000):
            texts = [t.as_py() or "" for t in batch.column(batch.schema.names.index(text_col))]
            count, size, letters = parser.phrases(texts)
            cost = count * parser.cost[:, None] / np.maximum(size, 1)
            langs, scores, rates = [], [], []
            for i in range(len(texts)):
                if not letters[i] or not told:
                    langs.append("und"), scores.append(0.0), rates.append(None)
                    continue
                order = np.argsort(cost[:, i], kind="stable")
                best, second = cost[order[0], i], cost[order[1], i] if len(told) > 1 else math.inf
                langs.append(told[order[0]]), rates.append(count[order[0], i] / size[i])
                scores.append(1.0 if second == math.inf else second / (best + second))
            out = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]
            if strange_out is not None:
                out.append(pa.array([parser.strange(t) for t in texts], pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    kinds = ["string", "double", "double", "double"]
    return docs.mapInArrow(run, ", ".join([fields, *(f"`{n}` {k}" for n, k in zip(names, kinds, strict=False))]))
