"""Operator 12: level-wise doubling over word windows.

Windows grow from four words to the length asked for (13: 4, 7, 13), each length
at most twice the one before, and a window is looked at only if its part of the
length before occurs in two blocks or in two documents of one block.  When no
window survives a length, the search ends.

Lengths below the last are looked at where the text itself chooses: a window's
part is the one of least hash among its parts of half the length, and the shorter
lengths begin at the same word.  Equal windows have equal parts, so no repeat is
lost; about a quarter of all words begin a part.  These lengths only sieve, with 32
bits of a hash inside a bucket.  At the last length each block sends its distinct
windows (96 bits of two independent hashes, and the bits of the bucket) with its
smallest document, and the bucket answers whether another block has a smaller one.
Two different windows with one such key would need chance of about pairs / 2**96.

Defined cases: a null or blank text has no words and nothing is removed; a document
without an id comes after all others; rows of one id never remove each other's
words; equal texts are judged as any others; a text of any length stays whole, in
one block; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import bucket_of, mix
from .coded import BLOCK, BUCKET, Coded, bits_of, bucket_count, coded_blocks, pair_hash, replies_of, split_sorted, table_of
from .common import materialize, tidy

WORDS, FIRST = 13, 4
_ASK = "block long, level int, bucket int, keys binary, more binary, docs binary, counts binary"
_REPLY = "block long, level int, bucket int, bits binary, survivors long"


def lengths(words: int) -> list[int]:
    """1, 2, 4, 7, 13: each at most twice the one before."""
    found = [words]
    while found[-1] > 1:
        found.append((found[-1] + 1) // 2)
    return found[::-1]


def sieve_lengths(words: int) -> list[int]:
    return [n for n in lengths(words)[:-1] if n >= min(FIRST, words // 2)]


class Windows:
    """The windows of a block's documents, one after another."""

    def __init__(self, coded: Coded, words: int):
        self.coded, self.size = coded, words
        self.levels = sieve_lengths(words)
        ends = np.cumsum(coded.lens)
        self.doc = np.repeat(np.arange(len(coded.lens)), coded.lens)
        self.valid = np.arange(len(self.doc)) + words <= np.repeat(ends, coded.lens)

    @cached_property
    def hashes(self) -> dict[int, np.ndarray]:
        """Of every length: the hash of the window that begins at each word (across documents: never used); -1: a second hash of the last length."""
        raw = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.coded.words)), np.uint64).reshape(-1, 2)
        codes, out = self.coded.codes, {}
        for half in (0, 1):
            before, h = 1, raw[:, half][codes] if len(raw) else np.zeros(0, np.uint64)
            out[1, half] = h
            for n in lengths(self.size)[1:]:
                h = pair_hash(h, _later(h, n - before))
                before, out[n, half] = n, h
        return {n: out[n, 0] for n in lengths(self.size)} | {-1: out[self.size, 1]}

    @cached_property
    def anchor(self) -> np.ndarray:
        """For each word the place of the chosen part of the window that begins there."""
        if not self.levels:
            return np.arange(len(self.doc))
        part = self.levels[-1]
        h = mix(self.hashes[part])
        places = self.size - part + 1
        least = h.copy()
        for k in range(1, places):
            np.minimum(least, _later(h, k), out=least)
        at = np.zeros(len(h), np.int64)
        for k in range(places - 1, -1, -1):  # the first of equal ones
            at[_later(h, k) == least] = k
        return np.minimum(np.arange(len(h)) + at, max(len(h) - 1, 0))

    def candidates(self, level: int, alive: np.ndarray | None) -> np.ndarray:
        """Places whose window of ``level`` is to be looked at; ``alive``: places that survived the length before."""
        starts = np.flatnonzero(self.valid if alive is None else self.valid & alive[self.anchor])
        if level == self.size:
            return starts
        chosen = np.zeros(len(self.doc), bool)
        chosen[self.anchor[starts]] = True
        return np.flatnonzero(chosen)


def _later(h: np.ndarray, k: int) -> np.ndarray:
    """Each place's value ``k`` further on (zero past the end)."""
    out = np.zeros_like(h)
    if k < len(h):
        out[: len(h) - k] = h[k:]
    return out


class Sieve:
    """A length's distinct keys in a block, in order of their buckets."""

    def __init__(self, windows: Windows, level: int, alive: np.ndarray | None, buckets: int):
        self.at = windows.candidates(level, alive)
        h = windows.hashes[level][self.at]
        key = (bucket_of(h, buckets).astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        self.keys, self.inverse = np.unique(key, return_inverse=True)
        low, high = _extremes(windows.coded.heads[windows.doc[self.at]], self.inverse, len(self.keys))
        self.local, self.total = low < high, len(windows.doc)

    def asks(self, block: int, level: int) -> Iterator[tuple]:
        for k, own in split_sorted(self.keys >> np.uint64(32)):
            yield block, level, k, (self.keys[own] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), np.packbits(self.local[own]).tobytes(), b"", b""

    def alive(self, replies: dict[int, bytes]) -> np.ndarray:
        kept = np.zeros(len(self.keys), bool)
        for k, own in split_sorted(self.keys >> np.uint64(32)):
            kept[own] = bits_of(replies[k], own.stop - own.start)
        out = np.zeros(self.total, bool)
        out[self.at] = kept[self.inverse]
        return out


def _extremes(docs: np.ndarray, inverse: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, inverse))
    first = np.searchsorted(inverse[order], np.arange(n + 1))
    ordered = docs[order]
    return ordered[first[:-1]], ordered[first[1:] - 1]


class Exact:
    """The distinct windows of the last length with their smallest document, in order of (bucket, document)."""

    def __init__(self, windows: Windows, alive: np.ndarray | None, buckets: int):
        self.at = windows.candidates(windows.size, alive)
        a, b = windows.hashes[windows.size][self.at], windows.hashes[-1][self.at].astype(np.uint32)
        docs = windows.coded.heads[windows.doc[self.at]]
        order = np.lexsort((docs, b, a))
        first = np.ones(len(order), bool)
        first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        number = np.cumsum(first) - 1
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = number
        pick = order[first]
        a, b, low = a[pick], b[pick], docs[pick]
        own = bucket_of(a, buckets)
        self.order = np.lexsort((low, own))  # of the distinct windows, as sent
        self.a, self.b, self.low, self.bucket = a[self.order], b[self.order], low[self.order], own[self.order]
        self.later = docs > low[self.inverse]

    def asks(self, block: int, level: int) -> Iterator[tuple]:
        for k, own in split_sorted(self.bucket):
            docs, counts = np.unique(self.low[own], return_counts=True)
            yield block, level, k, self.a[own].tobytes(), self.b[own].tobytes(), docs.tobytes(), counts.astype(np.uint32).tobytes()

    def repeated(self, replies: dict[int, bytes]) -> np.ndarray:
        """Places whose window also begins in a document of smaller id."""
        said = np.zeros(len(self.a), bool)
        for k, own in split_sorted(self.bucket):
            said[own] = bits_of(replies[k], own.stop - own.start)
        elsewhere = np.empty(len(said), bool)
        elsewhere[self.order] = said
        return self.at[self.later | elsewhere[self.inverse]]


def _meet(table: pa.Table) -> pa.Table:
    """A bucket of a sieve: keys that two blocks have, or two documents of one."""
    keys = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
    local = [bits_of(x, len(k)) for x, k in zip(table["more"].to_pylist(), keys, strict=True)]
    every = np.sort(np.concatenate([*keys, *(k[f] for k, f in zip(keys, local, strict=True))]))  # a key that repeats in its block counts twice
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for block, level, bucket, own in zip(*(table[c].to_pylist() for c in ("block", "level", "bucket")), keys, strict=True):
        hit = np.isin(own, twice, assume_unique=True)
        out.append((block, level, bucket, np.packbits(hit).tobytes(), int(hit.sum())))
    return table_of(out, _REPLY)


def _judge(table: pa.Table) -> pa.Table:
    """A bucket of the last length: whether another block has a smaller document."""
    c = {k: table[k].to_pylist() for k in ("block", "level", "bucket", "keys", "more", "docs", "counts")}
    a, b = (np.concatenate([np.frombuffer(x, kind) for x in c[name]]) for name, kind in (("keys", np.uint64), ("more", np.uint32)))
    docs = np.concatenate([np.repeat(np.frombuffer(x, np.int64), np.frombuffer(n, np.uint32)) for x, n in zip(c["docs"], c["counts"], strict=True)])
    order = np.lexsort((docs, b, a))
    x, y, z = a[order], b[order], docs[order]
    first = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    later = np.empty(len(order), bool)
    later[order] = z > z[first][np.cumsum(first) - 1]
    out, at = [], 0
    for block, level, bucket, own in zip(c["block"], c["level"], c["bucket"], c["keys"], strict=True):
        hit = later[at : at + len(own) // 8]
        at += len(hit)
        out.append((block, level, bucket, np.packbits(hit).tobytes(), int(hit.sum())))
    return table_of(out, _REPLY)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, block_bytes: int = BLOCK, bucket_bytes: int = BUCKET) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    buckets = bucket_count(docs, text_col, bucket_bytes)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    states = coded_blocks(slim, "doc_id", "text", lambda text, _: text.split(), "windows-coded", block_bytes)
    sieves = sieve_lengths(words)

    def read(table: pa.Table) -> Windows:
        return Windows(Coded(table.to_pylist()[0]), words)

    def sieved(w: Windows, found: dict[int, dict[int, bytes]], upto: int) -> np.ndarray | None:
        alive = None
        for level in sieves[:upto]:
            alive = Sieve(w, level, alive, buckets).alive(found.get(level, {}))
        return alive

    def asks_of(w: Windows, found: dict[int, dict[int, bytes]], step: int) -> pa.Table:
        alive = sieved(w, found, step)
        level = [*sieves, words][step]
        asked = Sieve(w, level, alive, buckets) if step < len(sieves) else Exact(w, alive, buckets)
        rows = list(asked.asks(w.coded.block, level))
        tidy()
        return table_of(rows, _ASK)

    def ask(step: int) -> DataFrame:
        if not step:

            def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for k in range(batch.num_rows):
                        yield from asks_of(read(pa.Table.from_batches([batch.slice(k, 1)])), {}, 0).to_batches()

            return states.mapInArrow(first, _ASK)

        def later(table: pa.Table, replies: pa.Table) -> pa.Table:
            return asks_of(read(table), replies_of(replies), step) if table.num_rows else table_of([], _ASK)

        return states.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(later, _ASK)

    told: DataFrame | None = None
    alive = True
    for step, level in enumerate([*sieves, words]):
        reply = materialize(ask(step).groupBy("bucket").applyInArrow(_judge if level == words else _meet, _REPLY), f"windows-{level}")
        told = reply if told is None else told.unionByName(reply)
        if level != words and not reply.agg(F.sum("survivors")).first()[0]:
            alive = False
            break

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _cut([], [], [], [])
        w = read(table)
        gone = np.zeros(len(w.doc) + 1, np.int64)
        if alive:
            found = replies_of(replies)
            at = Exact(w, sieved(w, found, len(sieves)), buckets).repeated(found.get(words, {}))
            np.add.at(gone, at, 1)
            np.add.at(gone, at + words, -1)
        stays = np.cumsum(gone[:-1]) == 0
        lexicon, ends = w.coded.words, np.cumsum(w.coded.lens)
        ids = w.coded.heads
        kept = []
        for end, n in zip(ends.tolist(), w.coded.lens.tolist(), strict=True):
            own = w.coded.codes[end - n : end][stays[end - n : end]]
            kept.append(b" ".join([lexicon[c] for c in own.tolist()]))
        removed = np.concatenate(([0], np.cumsum(~stays)))
        out = _cut(ids, w.coded.lens, removed[ends] - removed[ends - w.coded.lens], kept)
        tidy()
        return out

    def _cut(ids: np.ndarray, n_words: np.ndarray, n_removed: np.ndarray, kept: list[bytes]) -> pa.Table:
        ids = pa.array(ids, pa.int64())
        ids = pc.if_else(pc.equal(ids, np.iinfo(np.int64).max), None, ids)
        return pa.table([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return states.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def op12_substring_dedup(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
