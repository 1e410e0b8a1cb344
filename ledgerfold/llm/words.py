"""Words, word hashes and shingle hashes of a block of texts, as arrays.

Words are runs of characters other than space and 0x09-0x0D, with A-Z lowered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and each text's bounds among them (n + 1)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("").cast(pa.string())))
    flat, bounds = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        flat = flat.filter(pa.array(full))
    return flat, bounds


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word and each text's bounds; each distinct word is hashed once."""
    flat, bounds = split_words(texts)
    coded = flat.dictionary_encode()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return (own[np.asarray(coded.indices)] if len(flat) else np.zeros(0, np.uint64)), bounds


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; the last n - 1 positions have none."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mix(out * _STEP + words[k : k + size] + np.uint64(k + 1))
    return out


def shingle_sets(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their bounds.

    A text with 1 to n - 1 words is one shingle of all its words; one without words has none.
    """
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    grams = ngram_hashes(words, n)
    short = np.flatnonzero((counts > 0) & (counts < n))
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
    starts = np.repeat(bounds[:-1], np.maximum(counts - n + 1, 0))
    at = starts + np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(np.maximum(counts - n + 1, 0))])[:-1], np.maximum(counts - n + 1, 0))
    hashes = grams[at] if len(at) else np.zeros(0, np.uint64)
    if len(short):
        own = np.array([ngram_hashes(words[bounds[i] : bounds[i + 1]], int(counts[i]))[0] ^ np.uint64(counts[i]) for i in short], np.uint64)
        owner, hashes = np.concatenate([owner, short]), np.concatenate([hashes, own])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a block (letters only, lower case; empty ones too), each occurrence's word, and the texts' bounds."""
    flat, bounds = split_words(texts)
    coded = flat.dictionary_encode()
    letters = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}]+", "")
    again = letters.dictionary_encode()
    index = np.asarray(again.indices)[np.asarray(coded.indices)] if len(flat) else np.zeros(0, np.int64)
    return again.dictionary, index, bounds
