"""Ids of a tokenizers-library vocabulary, one library call for each new piece of text."""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from codecs import charmap_decode
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderlake.llm._batch import BatchCoder, Pool, cut_at_spaces, regroup, spread
from orderlake.llm._io import KEPT, let_go
from orderlake.llm._text import PieceCache, is_word, space_chunks

#: Fixed value: the split that a byte-level pre-tokenizer applies when its file names no other.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed value: the split of the lower-casing word-end vocabulary's file.
WORD_END_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

#: Pieces with characters from here on (beyond Latin letters) go through the library's whole chain.
_FAR = "ɐ"

#: Pieces of text whose ids a worker remembers; only speed and memory depend on it.
REMEMBERED = 500_000

#: Words that are handed to the library's model in one call: what it tells of each token takes far more memory than the ids.
_CALL = 20_000

_CODERS: dict[str, BatchCoder] = {}
KEPT.append(_CODERS)


def _byte_spelling() -> str:
    """The 256 characters that stand for bytes in byte-level vocabularies: printable ones themselves, the others from U+0100 on in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = sorted({*range(256)} - shown)
    return "".join(chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256))


#: What a byte of a text is to the two splits: part of a letter (those of ASCII and from U+00C0 on), a digit, a mark, a space, a line's end, else.
_LETTER, _DIGIT, _MARK, _SPACE, _BREAK, _ELSE = range(6)
_KINDS = np.full(256, _ELSE, np.uint8)
_KINDS[33:127] = _MARK
_KINDS[ord("0"):ord("9") + 1] = _DIGIT
_KINDS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
_KINDS[[ord(" "), ord("\n"), ord("'")]] = _SPACE, _BREAK, _ELSE

#: Pairs of bytes from 0xC300 on that are no letters, or one that is lower-cased to two characters (U+0130), or far (U+0250 on).
_NO_LETTERS = np.zeros(1 << 16, bool)
_NO_LETTERS[[0xC397, 0xC3B7, 0xC4B0, *range(0xC990, 0xC9C0)]] = True

#: The pieces of which ``cut_by_kinds`` knows that each is a single word. In place of {}: + where digits stay together.
_SINGLE = r"\A ?(?:[A-Za-zÀ-ÖØ-öø-įı-ɏ]+|[0-9]{}|[!-&(-/:-@\[-`{{-~]+)\z"


def cut_by_kinds(texts: pa.Array, digits_alone: bool) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(number of pieces of each text, the number of each piece, the distinct pieces) as the two splits cut, spaces staying before words.

    Between two spaces, Latin letters, digits and ASCII marks are words as far
    as they stand together, and so is a line's end. What holds anything else
    there, an apostrophe or two lines' ends is one piece, up to the next space.
    """
    if not len(texts) or not texts.buffers()[2]:
        return np.zeros(len(texts), np.int64), np.zeros(0, np.int64), []
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw, at = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]], at - at[0]
    kinds = _KINDS[raw]
    leads = np.flatnonzero((raw >= 0xC3) & (raw < 0xCA))
    kinds[leads[_NO_LETTERS[raw[leads].astype(np.int64) << 8 | raw[leads + 1]]]] = _ELSE
    begins = kinds == _SPACE
    begins[at[:-1][at[:-1] < len(raw)]] = True
    spaced = np.flatnonzero(begins)
    odd = kinds == _ELSE
    odd[1:] |= (kinds[1:] == _BREAK) & (kinds[:-1] == _BREAK)
    whole = np.unique(np.searchsorted(spaced, np.flatnonzero(odd), "right") - 1)
    kinds[spread(spaced[whole], np.diff(spaced, append=len(raw))[whole])] = _ELSE
    other = kinds[1:] != kinds[:-1]
    if digits_alone:
        other |= kinds[1:] == _DIGIT
    begins[1:] |= other & (kinds[:-1] != _SPACE)
    first = np.flatnonzero(begins)
    per_text = np.diff(np.searchsorted(first, at))
    ends = np.append(first, len(raw)).astype(np.int32)
    coded = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(raw)).dictionary_encode()
    return per_text, coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def coder(path: str, limit: int = REMEMBERED) -> BatchCoder:
    """Texts -> ids; what is remembered (``limit`` pieces) is kept for each Python worker, between its tasks.

    The ids are those of ``encode(text, add_special_tokens=False)``. Latin
    pieces are split by the file's own pattern and handed to the library's BPE
    model; all others go through its whole chain. A text that holds the content
    of an added token (which the library matches in texts whatever that flag
    says) is given to the library as it is.
    """
    if path not in _CODERS:
        _CODERS.clear()   # a worker keeps one vocabulary
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        split, lower = _short_way(told)
        model, spelling = whole.model, _byte_spelling()
        added = [t["content"] for t in told.get("added_tokens") or []]
        # Contents that are matched after normalising can hide in other spellings; then every text goes the whole way.
        hidden = any(t.get("normalized") and told.get("normalizer") for t in told.get("added_tokens") or [])

        def by_chain(text: str) -> list[int]:
            return whole.encode(text, add_special_tokens=False).ids

        def has_added(text: str) -> bool:
            return hidden or any(a in text for a in added)

        find = regex.compile(split).findall if split else None
        simple = split in (BYTE_LEVEL_SPLIT, WORD_END_SPLIT)   # the pieces that ``_SINGLE`` describes are one word there
        single_word = _SINGLE.format("" if lower else "+")
        words_alone, words_joined, pool = Tokenizer(model), Tokenizer(model), Pool(limit)
        words_joined.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        joined_spelling, widths = spelling[:255] + " ", _widths(told["model"])   # UTF-8 has no byte 255

        def by_parts(chunk: str) -> bool:
            """Whether the pattern and the model give what the whole chain gives."""
            return split is not None and (chunk.isascii() or max(chunk) < _FAR and not (lower and not unicodedata.is_normalized("NFC", chunk)))

        def spelled(word: str) -> str:
            return charmap_decode(word.encode(), "strict", spelling)[0]

        def by_model(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
            for at in range(0, len(words), _CALL):
                part = [w.encode() for w in words[at:at + _CALL]]
                for of, found in zip((sizes, ids), joined(part) or apart(part), strict=True):
                    of.append(found)
            return np.concatenate(sizes), np.concatenate(ids)

        def joined(part: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
            """Sizes and ids by the model alone, the words as one text: their tokens are as wide as they are. None if they are not."""
            if widths is None:
                return None
            found = words_joined.encode_batch_fast([charmap_decode(b"\xff".join(part), "strict", joined_spelling)[0]], add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            until, ends = np.cumsum(widths[ids]), np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
            if not len(ids) or until[-1] != ends[-1]:
                return None
            return np.diff(np.searchsorted(until, ends, "right"), prepend=0), ids

        def apart(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            """The same, the words as a list."""
            found = words_alone.encode([charmap_decode(w, "strict", spelling)[0] for w in part], is_pretokenized=True, add_special_tokens=False)
            return np.bincount(np.array(found.word_ids, np.int64), minlength=len(part)), np.array(found.ids, np.uint32)

        def make(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ways = np.zeros(len(chunks), np.int8)   # 0: a single word, 1: cut by the pattern, 2: the whole chain
            if simple:
                others = np.flatnonzero(~pc.match_substring_regex(pa.array(chunks, pa.string()), single_word).to_numpy(zero_copy_only=False))
            else:
                others = np.arange(len(chunks))
            ways[others] = [1 if by_parts(chunks[i]) else 2 for i in others.tolist()]
            single, cut, far = ([chunks[i] for i in np.flatnonzero(ways == k).tolist()] for k in range(3))
            if lower:
                single = [c.strip(" ").lower() for c in single]
            number: dict[str, int] = {}   # each distinct word is coded once
            at_words, n_words = array("q"), array("q")
            for c in cut:
                found = find(c.lower() if lower else c)
                n_words.append(len(found))
                at_words.extend([number.setdefault(w, len(number)) for w in found])
            distinct = list(number)
            held = pool.find([" " + w for w in distinct] if lower else distinct)   # letters alone are a chunk there
            held[[i for i in np.flatnonzero(held >= 0).tolist() if not (simple and is_word(distinct[i]))]] = -1
            fresh = np.flatnonzero(held < 0)
            sizes, ids = by_model(single + [distinct[i] for i in fresh.tolist()])
            old_sizes, old_ids = pool.rows(held[held >= 0])
            chained = [by_chain(c) for c in far]
            sizes = np.concatenate([sizes, old_sizes, np.array([len(c) for c in chained], np.int64)])
            ids = np.concatenate([ids, old_ids, np.array([i for c in chained for i in c], np.uint32)])
            # A chunk's ids are those of its words in turn. The words stand as: single ones, words of cut chunks (fresh, then held ones), chained chunks.
            of_word = np.zeros(len(distinct), np.int64)
            of_word[fresh], of_word[held >= 0] = np.arange(len(fresh)), np.arange(len(fresh), len(distinct))
            counts = np.ones(len(chunks), np.int64)
            counts[ways == 1] = n_words
            ways, places = np.repeat(ways, counts), np.zeros(int(counts.sum()), np.int64)
            places[ways == 0] = np.arange(len(single))
            places[ways == 1] = of_word[np.frombuffer(at_words, np.int64)] + len(single)
            places[ways == 2] = np.arange(len(far)) + len(single) + len(distinct)
            each = sizes[places]
            return regroup(counts, each), ids[spread((np.cumsum(sizes) - sizes)[places], each)]

        words = PieceCache(lambda p: [t.id for t in model.tokenize(spelled(p))], limit // 8)

        def numbers(chunk: str) -> bytes:
            return words.of(find(chunk.lower() if lower else chunk)) if by_parts(chunk) else array("I", by_chain(chunk)).tobytes()

        def one(text: str):
            if has_added(text):
                return by_chain(text)
            return np.frombuffer(b"".join(map(numbers, space_chunks(text))), np.uint32)

        _CODERS[path] = BatchCoder(make, one, ("",) if hidden else tuple(added), pool,
                                   cut=partial(cut_by_kinds, digits_alone=lower) if simple else cut_at_spaces)
    return _CODERS[path]


def _widths(model: dict) -> np.ndarray | None:
    """Bytes that each id of a byte-level vocabulary stands for; None where something else than bytes can have an id."""
    if model.get("type") != "BPE" or model.get("unk_token") is not None or model.get("continuing_subword_prefix"):
        return None
    end = model.get("end_of_word_suffix") or ""
    widths = np.zeros(max(model["vocab"].values()) + 1, np.int64)
    for token, i in model["vocab"].items():
        widths[i] = len(token.removesuffix(end))
    return widths


def _short_way(told: dict) -> tuple[str | None, bool]:
    """(split pattern, whether texts are lower-cased) of the two kinds of chain that are known here, else (None, False)."""
    norm, pre = told.get("normalizer"), told.get("pre_tokenizer") or {}
    if norm is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True):
        return BYTE_LEVEL_SPLIT, False
    steps = [s.get("type") for s in (norm or {}).get("normalizers", [])]
    inner = pre.get("pretokenizers", [])
    if (steps == ["NFC", "Replace", "Lowercase"] and norm["normalizers"][1].get("content") == " " and len(inner) == 2
            and inner[0].get("type") == "Split" and inner[0].get("invert") and inner[0].get("behavior") == "Removed"
            and inner[1].get("type") == "ByteLevel" and not inner[1].get("use_regex")):
        return inner[0]["pattern"]["Regex"], True
    return None, False


def start_task() -> None:
    """Called in a worker: what operators keep there goes, all but the vocabulary and what is remembered with it."""
    let_go(_CODERS)


def ids_of(path: str, texts: pa.Array, end_id: int | None = None, limit: int = REMEMBERED) -> list[bytes]:
    """Ids of each whole text (null: empty) and ``end_id`` if given, as little-endian 32-bit bytes."""
    sizes, ids = coder(path, limit).code(texts)
    end = b"" if end_id is None else end_id.to_bytes(4, "little")
    raw, at = ids.astype("<u4").tobytes(), np.concatenate([[0], 4 * np.cumsum(sizes)]).tolist()
    return [raw[a:b] + end for a, b in zip(at, at[1:], strict=False)]
