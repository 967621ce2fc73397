"""Word shingles of whole texts as 64-bit hashes, for near-duplicate search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Odd constants of a 64-bit mixing function (fixed values).
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed ``width``-word shingles of each text, sorted, in a row;
    and where each text's shingles start (one more entry than texts).

    Letters A-Z are lower-cased, words are runs of anything but ASCII white
    space; with fewer than ``width`` words the whole sequence is one shingle,
    without words there is none."""
    spaced = pc.fill_null(texts.cast(pa.large_string()), "")
    for space in "\t\n\x0b\x0c\r":
        spaced = pc.replace_substring(spaced, space, " ")
    lists = pc.split_pattern(spaced, " ")
    coded = lists.flatten().dictionary_encode()
    names = pc.ascii_lower(coded.dictionary).to_pylist()  # ascii_lower is wrong on slices; a dictionary is none
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    words = coded.indices.to_numpy()
    real = np.fromiter((w != "" for w in names), bool, len(names))[words]  # splitting leaves empty ends
    ends = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    words = hashes[words[real]]
    rolled = np.zeros(len(words), np.uint64)
    for k in range(width):
        rolled[:len(words) - k] = mix(rolled[:len(words) - k] ^ words[k:]) + M1
    found, counts = [], np.zeros(len(ends), np.int64)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        if b - a >= width:
            own = np.unique(rolled[a:b - width + 1])
        elif b > a:
            short = np.uint64(b - a)
            for w in words[a:b]:
                short = mix(np.array([short ^ w]))[0] + M1
            own = np.array([short], np.uint64)
        else:
            continue
        found.append(own)
        counts[i + 1] = len(own)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), np.cumsum(counts)
