"""Packing token sequences: best-fit decreasing over a segment tree.

Documents are tokenised where they are read; only piece descriptors (a few
numbers each) are shuffled.  A document longer than a window is first cut into
full windows, its rest joins the pieces to be packed.  Pieces are dealt by a hash
of document and text to independent packing groups of about ``group_docs``
documents; in each the pieces go, longest first, into the open window with the
tightest remaining capacity, found in a segment tree indexed by capacity.

Edge cases: a null text is empty (one end token); equal lengths are ordered by
document and start; repeated rows are packed each; an empty table gives an empty
result; extra columns are ignored; rows without an id are dealt by their place in
the input, so their groups, not their pieces, may differ from run to run.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidied, tidy

WINDOW = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, grp int"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: The public byte-level pre-token pattern of this vocabulary (a fixed value).
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, with a bounded memory of pieces.

    A blank before a visible character always begins a new pre-token, so a text
    is encoded blank by blank and each distinct piece of a batch only once.  Texts
    that hold the string of an added token are left to the public library.
    """

    def __init__(self, tokenizer_path: str, end_id: int = 0, memory: int = 50_000):
        import tiktoken

        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of, special = _byte_of(), {t["content"] for t in spec.get("added_tokens", ())}
        self.path, self.special, self.library = tokenizer_path, sorted(special), None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.encode = tiktoken.Encoding("byte-bpe", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.n_bytes = np.zeros(max(ranks.values()) + 1, "i8")
        for token, i in ranks.items():
            self.n_bytes[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.memory, self.end = memory, np.array([end_id], "<u4").tobytes()

    def _by_library(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        ids = np.array(self.encode(" " + " ".join(new)), "<u4")
        ends = np.cumsum([len(p.encode()) + 1 for p in new])
        cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends, "left") + 1
        raw, at = ids.tobytes(), 0
        for p, cut in zip(new, (cuts * 4).tolist(), strict=True):
            self.known[p] = raw[at:cut]
            at = cut

    def batch(self, texts: list[str | None]) -> Iterator[bytes]:
        parted = [t.split(" ") if t else None for t in texts]
        plain = [p is not None and all([x and not x[0].isspace() for x in p[1:]]) for p in parted]
        added = [bool(t) and any([x in t for x in self.special]) for t in texts]
        plain = [ok and not a for ok, a in zip(plain, added, strict=True)]
        seen: set[str] = set()
        for parts, ok in zip(parted, plain, strict=True):
            if ok:
                seen.update(parts[1:])
        if new := [p for p in seen if p not in self.known]:
            if len(self.known) + len(new) > self.memory:
                self.known.clear()
                new = list(seen)
            self._learn(new)
        known = self.known
        for text, parts, ok, a in zip(texts, parted, plain, added, strict=True):
            if not text:
                yield self.end
            elif a:
                yield self._by_library(text) + self.end
            elif ok:
                head = np.array(self.encode(parts[0]), "<u4").tobytes() if parts[0] else b""
                yield head + b"".join([known[p] for p in parts[1:]]) + self.end
            else:  # runs of white space
                yield np.array(self.encode(text), "<u4").tobytes() + self.end


class CapacityTree:
    """Segment tree over remaining capacities 0..size: the least capacity of at least n that is open."""

    def __init__(self, size: int):
        self.base = 1
        while self.base <= size:
            self.base *= 2
        self.count = [0] * (2 * self.base)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, bin_: tuple[int, int]) -> None:
        self.open[capacity].append(bin_)
        i = self.base + capacity
        while i:
            self.count[i] += 1
            i //= 2

    def take(self, least: int) -> tuple[int, tuple[int, int]] | None:
        i = self.base + least
        if not self.count[i]:
            while i > 1 and (i % 2 or not self.count[i + 1]):  # climb until a right sibling has open bins
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.base
        bin_ = self.open[capacity].pop()
        while i:
            self.count[i] -= 1
            i //= 2
        return capacity, bin_


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Bins and offsets of pieces that come longest first."""
    tree, bins, offsets, n = CapacityTree(window), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            bin_, used, n = n, 0, n + 1
        else:
            bin_, used = found[1]
        bins.append(bin_)
        offsets.append(used)
        if used + length < window:
            tree.add(window - used - length, (bin_, used + length))
    return bins, offsets


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer_path: str, groups: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    @tidied
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(tokenizer_path, None) or Encoder(tokenizer_path)
        _encoders[tokenizer_path] = encoder
        encoder.known.clear()
        step = 4 * window
        for batch in (b.slice(i, 128) for b in batches for i in range(0, b.num_rows, 128)):  # words of few texts at a time
            rows = []
            docs_, texts, groups_ = (c.to_pylist() for c in batch.columns)
            for doc, ids, group in zip(docs_, encoder.batch(texts), groups_, strict=True):
                total = len(ids) // 4
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    rows.append((doc, at // 4, len(piece) // 4, zlib.crc32(piece), total, group))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.int32()], strict=True)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grp"],
            ) if rows else pa.RecordBatch.from_pylist([], schema=pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("grp", pa.int32())]))

    # rows alike (a third may have neither id nor text) are dealt by their place, which only decides the group
    place = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    group = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), place), F.lit(groups)).cast("int")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col), group.alias("grp")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, group_docs: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    groups = max(1, -(-docs.count() // group_docs))

    def fit(table: pa.Table) -> pa.Table:
        length = table["length"].to_numpy()
        order = np.lexsort((table["start"].to_numpy(), table["doc_id"].to_numpy(), -length))
        table = table.take(pa.array(order))
        bins, offsets = best_fit_decreasing(table["length"].to_pylist(), window)
        tidy()
        first = np.int64(table["grp"][0].as_py()) << np.int64(32)
        return pa.table(
            [table[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [pa.array(np.array(bins, "i8") + first), pa.array(np.array(offsets, "i8"))],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    return pieces(docs, tokenizer_path, groups, window, id_col, text_col).groupBy("grp").applyInArrow(fit, PACKED)


def op3_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
