"""Words of whole texts as 64-bit hashes, and hashes of their runs.

A word is a run of characters other than the six ASCII white-space ones, A-Z
in lower case. Arrow splits a column and lists its distinct words; only those
are hashed in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(texts: pa.Array, most_bytes: int) -> list[pa.Array]:
    """A text column in parts of at most ``most_bytes`` of text, or one longer text each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)))
    parts, at = [], 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        parts.append(texts.slice(at, stop - at))
        at = stop
    return parts


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the column, offsets of each text's words); null counts as empty."""
    import xxhash

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    # A text of white space alone, or a blank at either end, gives empty strings; drop them.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), dtype=np.uint64, count=len(distinct))
    at = coded.indices.to_numpy(zero_copy_only=False)
    offsets -= offsets[0]
    if "" in distinct:
        real = at != distinct.index("")
        offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(real)))[offsets]
        at = at[real]
    return hashes[at], offsets


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of pairs of hashes; the order matters."""
    x = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` neighbouring words; entry i starts at word i."""
    out = words
    for n in range(1, length):
        out = mix(out[:-1], words[n:]) if len(words) > n else words[:0]
    return out
