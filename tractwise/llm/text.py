"""Words and shingles of texts as arrays of hashes, batch by batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def salt(step: int) -> np.uint64:
    """A different number for each step (multiples of the golden ratio)."""
    return np.uint64(0x9E3779B97F4A7C15 * step % 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixing bijection of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin and end.

    Words are runs of other than ASCII white space; ``lower`` folds A to Z. NULL has
    no words. Each different word of the batch is hashed once.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    texts = texts.take(pa.array(np.arange(len(texts))))  # a copy that begins at 0, as splitting needs
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    codes = coded.indices.to_numpy()
    ends = words.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    empty = names.index("") if "" in names else -1
    if empty >= 0:  # an edge of white space is no word
        there = codes != empty
        ends = np.concatenate([[0], np.cumsum(there)])[ends]
        codes = codes[there]
    return table[codes], ends


def shingle_sets(hashes: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct ``size``-word shingles of each text, and where each set begins and ends.

    A text with fewer words gives its whole sequence as one shingle; one without words, none.
    """
    counts = np.diff(ends)
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(size):
        rolled[: len(hashes) - k] += mixed(hashes[k:] ^ salt(k + 1))
    short = np.flatnonzero((counts > 0) & (counts < size))
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[:-1], n)
    shingles = mixed(rolled[at])
    first = np.cumsum(n) - n
    for i in short:
        part = hashes[ends[i]: ends[i + 1]]
        whole = sum(mixed(part[k: k + 1] ^ salt(k + 1)) for k in range(len(part)))
        shingles[first[i]] = mixed(whole ^ np.uint64(len(part)))[0]
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[new], owner[new]
    return shingles, np.searchsorted(owner, np.arange(len(counts) + 1))
