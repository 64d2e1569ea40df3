"""Blocks of documents: bounded groups that are processed as arrays.

A block holds the documents of one hash value, about ``target`` bytes of text.
Blocks exchange packed arrays (one row per block and bucket) with reducers that
own a bucket of the key space, so a key that is hot in the corpus reaches its
reducer once per block and not once per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits of a scrambled hash."""
    return ((hashes >> np.uint64(33)).astype(np.int64) * buckets) >> 31


def blocked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: int = 6_000_000) -> tuple[DataFrame, int]:
    """(doc_id, text, block) and the number of blocks, from the bytes of all texts."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 16)).first()[0] or 0
    n = max(1, -(-size // target))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(n)).cast("int")), n


def bucket_count(docs: DataFrame, blocks: int) -> int:
    """As many buckets as blocks: both grow with the bytes of all texts, so a reducer's share does not."""
    return max(1, blocks)


def sorted_docs(table: pa.Table) -> pa.Table:
    """The rows of a block in an order that does not depend on the shuffle."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def utf8(table: pa.Table, column: str = "text") -> list[bytes]:
    values = table[column].combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    return values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()).to_pylist()


def split_by(order: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Indices of each bucket, in their order; buckets without any cost nothing, however many there are."""
    index = np.argsort(order, kind="stable")
    found = order[index]
    edges = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1], [True]))) if len(found) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(found[a]), index[a:b]


class Table:
    """Exact lookup of the positions of distinct 64-bit keys, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys, n = keys, max(len(keys), 1)
        bits = max(4, int(4 * n - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        at, left = self._home(keys), np.arange(len(keys), dtype=np.int32)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for keys not in the table."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self._home(keys)
        out = self.slots[at]
        bad = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(bad):
            at[bad] = (at[bad] + 1) & self.mask
            out[bad] = self.slots[at[bad]]
            bad = bad[(out[bad] >= 0) & (self.keys[out[bad]] != keys[bad])]
        return out
