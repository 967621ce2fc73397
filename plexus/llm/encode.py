"""Whole-text encoding by a public tokenizer file, with a bounded cache of words.

Encoding is by far the dearest step of token output and packing.  Natural text
repeats its words, and a tokenizer that drops white space and never merges
across it encodes each word alone, so each worker keeps the ids of the words
it has seen.  The cache is bounded; words beyond it are encoded anew."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the pre-tokenizer pattern of the word tokenizer's file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters that NFC leaves alone and that lower-case one by one, in every
# Unicode version: printable ASCII and the precomposed Latin letters.
PLAIN = re.compile("[!-~À-įı-ſ]+")
# Punctuation and symbols after a letter or digit that NFC and lower-casing leave
# one letter or digit.  Words with any other end stay whole: marks may compose
# with the letter before, and some letters become a letter and a mark, which
# is one piece with the punctuation after it.
TAIL = r"([0-9A-Za-zÀ-ÖØ-öø-įı-ſα-ρσ-ώЀ-ҁҊ-ӿぁ-ゖァ-ヺ一-龥가-힣])([\pP\pS]+)$"


def word_lists(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut at spaces and line ends: where each text's words start (one
    more entry than texts), each word's number, and the distinct words."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    coded = lists.flatten().dictionary_encode()
    return lists.offsets.to_numpy(), coded.indices.to_numpy(), coded.dictionary


def ragged(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``pool[s:s + n]`` of all pairs (s, n), in a row."""
    upto = np.cumsum(sizes)
    return pool[np.repeat(starts - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)]


class Encoder:
    """``encode(texts)`` gives what ``Tokenizer.encode`` gives for each text
    (without special tokens), an end id after each."""

    def __init__(self, path: str, end_id: int | None = None, most: int = 400_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.end = [] if end_id is None else [end_id]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers") or []]
        self.by_word = (steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[0].get("invert") is True
                        and kinds == ["NFC", "Replace", "Lowercase"] and len(steps) == 2
                        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]))
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.inner = Tokenizer.from_file(path)  # for letters that are normalised already
        self.inner.normalizer = normalizers.Sequence([])
        self.inner.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.most, self.cache = most, {}
        self.pool, self.starts, self.sizes = array("I"), array("Q"), array("I")

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces, each alone."""
        tokenize, found, accented = self.full.model.tokenize, [[]] * len(pieces), []
        for k, piece in enumerate(pieces):
            if piece.isalpha() and piece.isascii():
                found[k] = [t.id for t in tokenize(piece)]
            elif piece.isalpha() and PLAIN.fullmatch(piece):
                accented.append(k)
            elif piece:
                found[k] = self.full.encode(piece, add_special_tokens=False).ids
        if accented:
            for k, e in zip(accented, self.inner.encode_batch_fast([pieces[k].lower() for k in accented],
                                                                   add_special_tokens=False), strict=True):
                found[k] = e.ids
        return found

    def _look_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pool, start and size of each piece's ids."""
        at = list(map(self.cache.get, pieces))
        new = [k for k, x in enumerate(at) if x is None]
        over: list[int] = []  # pieces beyond the cache live for this call only
        places = []
        for k, ids in zip(new, self._ids([pieces[k] for k in new]), strict=True):
            if len(self.cache) < self.most and len(pieces[k]) < 64:
                at[k] = self.cache[pieces[k]] = len(self.starts)
                self.starts.append(len(self.pool))
                self.sizes.append(len(ids))
                self.pool.extend(ids)
            else:
                at[k] = -1
                places.append((k, len(over), len(ids)))
                over.extend(ids)
        index = np.array(at, np.int64)
        kept = index >= 0
        starts, sizes = np.empty(len(index), np.int64), np.empty(len(index), np.int64)
        starts[kept] = np.array(self.starts, np.int64)[index[kept]]
        sizes[kept] = np.array(self.sizes, np.int64)[index[kept]]
        if places:
            k, s, n = np.array(places, np.int64).T
            starts[k], sizes[k] = s + len(self.pool), n
        return np.concatenate([np.array(self.pool, np.uint32), np.array(over, np.uint32)]), starts, sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and the number of ids of each text (null as empty)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        marked = any(pc.any(pc.match_substring(texts, m)).as_py() for m in ("<|", *self.marks))
        if marked or not self.by_word:
            found = [e.ids + self.end for e in self.full.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            counts = np.array([len(x) for x in found], np.int64)
            return np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum())), counts
        lists, index, words = word_lists(texts)
        # Punctuation after a letter or digit is a piece of its own.
        cut = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(words), TAIL, r"\1 \2"), " ")
        coded = cut.flatten().dictionary_encode()
        pool, starts, sizes = self._look_up(coded.dictionary.to_pylist())
        piece = coded.indices.to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes[piece])])[cut.offsets.to_numpy()]  # of the words' ids
        pool, starts, sizes = ragged(pool, starts[piece], sizes[piece]), upto[:-1], np.diff(upto)
        ends = lists[1:] - lists[0]
        if self.end:
            pool = np.append(pool, np.uint32(self.end[0]))
            index = np.insert(index.astype(np.int64), ends, len(starts))
            starts, sizes = np.append(starts, len(pool) - 1), np.append(sizes, 1)
            ends = ends + np.arange(1, len(ends) + 1)
        flat = ragged(pool, starts[index], sizes[index])
        return flat, np.diff(np.concatenate([[0], np.cumsum(sizes[index])])[ends], prepend=0)


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int | None, most: int = 400_000) -> Encoder:
    """One encoder per worker process and tokenizer file; ``most`` words are kept."""
    key = (path, end_id, most)
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id, most)
    return _encoders[key]
