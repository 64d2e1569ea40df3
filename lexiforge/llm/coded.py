"""Texts as numbers: blocks of documents with a local vocabulary, written once and read by every later pass.

A block is made where its rows are scanned, so texts are never shuffled: a task
numbers its blocks by its partition, and the written table fixes them.  A block
holds about ``BLOCK`` bytes of text, or one longer document.  Blocks exchange
packed arrays with buckets of a key space; a key that is hot in the corpus is sent
once per block.  The number of buckets is in proportion to the bytes of all texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix
from .common import materialize, tidy

BLOCK, BUCKET = 8_000_000, 16_000_000
_CODEC = "zstd"
STATE = "block long, n_docs long, lens binary, n long, codes binary, heads binary, words binary, n_words long, n_bytes long, sizes binary"


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers below 2**32 as compressed planes of bytes."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.Codec(_CODEC).compress(planes, asbytes=True)


def unpacked(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec(_CODEC).decompress(blob, 4 * n), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def bucket_count(docs: DataFrame, text_col: str, target: int = BUCKET) -> int:
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)))).first()[0] or 0
    return max(1, -(-size // target))


def coded_blocks(docs: DataFrame, head_col: str, text_col: str, tokens: Callable[[bytes, object], Sequence[bytes]], name: str, target: int = BLOCK) -> DataFrame:
    """Writes the blocks of ``docs``: the codes of each document's tokens, and its head where that is a long.

    ``tokens(text, head)`` are the tokens of a text, as bytes.
    """
    kind = docs.schema[head_col].dataType.simpleString()

    def block(number: int, heads: list, lens: list[int], codes: list[int], words: dict[bytes, int]) -> pa.RecordBatch:
        blob = np.array([_NO_HEAD if h is None else h for h in heads], np.int64).tobytes() if kind == "bigint" else b""
        joined = b"".join(words)
        row = [number, len(lens), packed(np.array(lens, np.int64)), len(codes), packed(np.array(codes, np.int64)), blob, pa.Codec(_CODEC).compress(joined, asbytes=True), len(words), len(joined), packed(np.array([len(w) for w in words], np.int64))]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in row], names=[c.split()[0] for c in STATE.split(", ")])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        heads, lens, codes, words, size = [], [], [], {}, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # a few texts at a time as Python objects
                part = batch.slice(start, 256)
                for head, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    found = tokens(text or b"", head)
                    codes += [words.setdefault(w, len(words)) for w in found]
                    heads.append(head)
                    lens.append(len(found))
                    size += len(text or b"") + 16
                    if size >= target:
                        yield block(number, heads, lens, codes, words)
                        heads, lens, codes, words, size, number = [], [], [], {}, 0, number + 1
        if heads:
            yield block(number, heads, lens, codes, words)
        tidy()

    slim = docs.select(F.col(head_col), F.col(text_col))
    return materialize(slim.mapInArrow(code, STATE), name)


_NO_HEAD = np.iinfo(np.int64).max


class Coded:
    """A block read again."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.codes = unpacked(row["codes"], row["n"])
        self.heads = np.frombuffer(row["heads"], np.int64)
        self.lens = unpacked(row["lens"], row["n_docs"]).astype(np.int64)
        joined = pa.Codec(_CODEC).decompress(row["words"], row["n_bytes"], asbytes=True)
        ends = np.cumsum(unpacked(row["sizes"], row["n_words"]).astype(np.int64)).tolist()
        self.words = [joined[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def replies_of(replies: pa.Table) -> dict[int, dict[int, bytes]]:
    """Bits by level and bucket."""
    found: dict[int, dict[int, bytes]] = {}
    for level, bucket, bits in zip(*(replies[c].to_pylist() for c in ("level", "bucket", "bits")), strict=True):
        found.setdefault(level, {})[bucket] = bits
    return found


def bits_of(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    """Rows under a schema of longs, ints, strings and binaries."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two neighbours' hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b + np.uint64(0x632BE59BD9B4E019))


def split_sorted(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal numbers of a sorted array; costs nothing for numbers that do not occur."""
    if len(buckets):
        edges = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1], [True])))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(buckets[a]), slice(a, b)
