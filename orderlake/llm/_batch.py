"""Token ids of whole batches of texts, each distinct chunk of text being encoded once as long as a worker remembers it."""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space with white space after it (all characters that Unicode calls so).
_WIDE = r" [\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Pool:
    """Rows of 32-bit numbers by key, in one growing array; ``rows`` gathers many of them at once."""

    def __init__(self, limit: int):
        self._limit, self._at, self._used, self._n = limit, {}, 0, 0
        self._flat = np.zeros(1 << 16, np.uint32)
        self._start, self._size, self._again = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), np.zeros(1 << 14, bool)

    def find(self, keys: list) -> np.ndarray:
        """The place of each key, -1 where it is not held."""
        return np.fromiter(map(self._at.get, keys, repeat(-1)), np.int64, len(keys))

    def places(self, keys: list, make: Callable[[list], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each key; those that are not held are made by ``make`` (keys -> sizes, numbers).

        Where too many are held, those that no later call asked for again are
        forgotten first, so places hold until the next call.
        """
        if len(self._at) > self._limit:
            self._forget()
        found = self.find(keys)
        self._again[found[found >= 0]] = True
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [keys[i] for i in missing.tolist()]
            self._add(new, *make(new))
            found[missing] = np.arange(self._n - len(new), self._n)
        return found

    def _forget(self) -> None:
        """Keep at most half of the limit, the later ones of those that were met again."""
        kept = np.flatnonzero(self._again[:self._n])
        kept = kept[max(0, len(kept) - self._limit // 2):]
        stays = np.zeros(self._n, bool)
        stays[kept] = True
        keys = list(compress(self._at, stays.tolist()))   # in the order of their places
        sizes, numbers = self.rows(kept)
        self._at, self._used, self._n = {}, 0, 0
        self._again[:] = False
        self._add(keys, sizes, numbers)

    def _add(self, keys: list, sizes: np.ndarray, numbers: np.ndarray) -> None:
        self._flat = _room(self._flat, self._used + len(numbers))
        self._start, self._size = _room(self._start, self._n + len(keys)), _room(self._size, self._n + len(keys))
        self._again = _room(self._again, self._n + len(keys))
        self._again[self._n:self._n + len(keys)] = False
        self._flat[self._used:self._used + len(numbers)] = numbers
        self._size[self._n:self._n + len(keys)] = sizes
        self._start[self._n:self._n + len(keys)] = self._used + np.cumsum(sizes) - sizes
        self._at.update(zip(keys, range(self._n, self._n + len(keys)), strict=True))
        self._used, self._n = self._used + len(numbers), self._n + len(keys)

    def rows(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(size of each row, all their numbers one after another)."""
        sizes = self._size[places].astype(np.int64)
        return sizes, self._flat[spread(self._start[places], sizes)]


def _room(a: np.ndarray, need: int) -> np.ndarray:
    if need <= len(a):
        return a
    more = np.empty(max(need, 2 * len(a)), a.dtype)   # what is not written yet takes no memory
    more[:len(a)] = a
    return more


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    until = np.cumsum(sizes)
    out = np.repeat(starts - until + sizes, sizes)
    out += np.arange(len(out))
    return out


def regroup(outer: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Totals of ``sizes`` taken ``outer[0]`` at a time, then ``outer[1]``, ..."""
    until = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.cumsum(outer)
    return until[ends] - until[ends - outer]


def gathered(batches, size: int = 8_000_000):
    """Record batches joined until they hold ``size`` bytes: the more text at once, the fewer lookups of its words."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def cut_at_spaces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(number of pieces of each text, the number of each piece, the distinct pieces), each text being cut before every U+0020."""
    pieces = pc.split_pattern(texts, " ")
    per_text = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(pieces).dictionary_encode()
    numbers = np.array(coded.indices.to_numpy(zero_copy_only=False))
    spelled = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    first = np.zeros(len(numbers), bool)   # a text's first piece has no space before it
    first[np.cumsum(per_text) - per_text] = True
    as_first = np.bincount(numbers[first], minlength=len(spelled))
    spaced, bare = np.flatnonzero(np.bincount(numbers, minlength=len(spelled)) > as_first), np.flatnonzero(as_first)
    of_spaced, of_bare = np.zeros(len(spelled), np.int64), np.zeros(len(spelled), np.int64)
    of_spaced[spaced], of_bare[bare] = np.arange(len(spaced)), np.arange(len(bare)) + len(spaced)
    numbered = of_spaced[numbers]
    numbered[first] = of_bare[numbers[first]]
    return per_text, numbered, [" " + spelled[i] for i in spaced.tolist()] + [spelled[i] for i in bare.tolist()]


class BatchCoder:
    """Texts -> (number of ids of each, all ids in turn as unsigned 32-bit numbers).

    ``make`` encodes pieces (list of str -> sizes, ids) that texts are cut into
    by ``cut``, by default before each U+0020; the patterns that precede
    byte-level merges always begin a word there unless white space follows.
    Texts in which it does somewhere, and those that hold one of the strings
    ``whole_if``, are encoded as one piece, and are not remembered.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], whole: Callable[[str], list[int]],
                 whole_if: tuple[str, ...] = (), pool: Pool | None = None, limit: int = 900_000,
                 cut: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, list[str]]] = cut_at_spaces):
        self._make, self._whole, self._whole_if, self._pool, self._cut = make, whole, whole_if, pool or Pool(limit), cut

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(texts, _WIDE)
        for held in self._whole_if:
            apart = pc.or_(apart, pc.match_substring(texts, held))
        odd = pc.indices_nonzero(apart).to_pylist()
        if odd:
            listed = texts.take(pa.array(odd)).to_pylist()
            texts = pc.if_else(apart, "", texts)
        per_text, numbers, keys = self._cut(texts)
        del texts
        pa.default_memory_pool().release_unused()   # Arrow's part is over; it would hold as much again as what follows takes
        at = self._pool.places(keys, self._encoded)[numbers]
        sizes, ids = self._pool.rows(at)
        per_text = regroup(per_text, sizes)
        if odd:
            return self._with_whole(per_text, ids, odd, listed)
        return per_text, ids

    def _encoded(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        filled = [k for k in keys if k]
        sizes, ids = self._make(filled)
        if len(filled) == len(keys):
            return sizes, ids
        every = np.zeros(len(keys), np.int64)   # an empty piece has no ids
        every[[i for i, k in enumerate(keys) if k]] = sizes
        return every, ids

    def _with_whole(self, per_text, ids, odd, listed):
        ends, out, at = np.cumsum(per_text), [], 0
        per_text = per_text.copy()
        for i, text in zip(odd, listed, strict=True):
            out += [ids[at:ends[i]], np.array(self._whole(text), np.uint32)]   # the blank text has no ids of its own
            at, per_text[i] = ends[i], len(out[-1])
        return per_text, np.concatenate([*out, ids[at:]]).astype(np.uint32)
