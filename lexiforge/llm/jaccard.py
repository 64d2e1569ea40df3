"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersections.

A document's set holds the hashes of its distinct word n-grams.  Sizes fall into
bands such that linked sets lie in one band or in neighbours; a tile is a pair of
neighbouring bands.  Linked sets of a tile differ in at most ``d`` members, so if
the hash space is cut into more than ``d`` parts, one part at least is the same in
both: sets meet in a tile if a part's signature agrees.  Nothing else is compared,
and no linked pair is missed.

Documents with equal sets are one class from the start (the smallest id stands for
it).  Candidates are checked first on 512-bit parity bitmaps, whose differing bits
bound the overlap from above, then on wider ones where sets have more than 512
members (these would fill the first), then on the sorted sets themselves.  In each group
of equal signatures all members are first tested against the smallest; only where
the links found leave a group in several components are the pairs across these
compared, in tiles of at most ``TILE`` members, bitmaps first.

Members are 64-bit hashes; sets count as equal if their sizes and 128 more bits are,
so among 10^10 distinct sets some pair is taken for equal with odds of 10^-19.

Edge cases: null, empty and blank texts have empty sets and no links; a row without
an id joins only documents with an equal set; a text of
fewer than ``n`` words has one member, the whole sequence; equal rows are linked;
rows that share an id are one document, linked to all that any of its texts is
linked to (but :func:`deduplicate` judges each row by itself); an empty table gives an
empty result; extra columns are ignored, and pass through :func:`deduplicate`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import bucket_of, mix, split_by
from .common import fresh_names, materialize, tidied, tidy
from .components import components

TILE = 1024
LOT = 500_000  # set members that one comparison holds, besides those of its centre
FLUSH = 300_000  # signatures that a task holds before it sends them
BUCKET = 1_000_000  # signatures a reducer gets, about
NEAR = 1_000_000  # pairs to verify that are broadcast (32 bytes each)
WORDS = 8  # of 64 bits in a bitmap
MOST_BITS = 1 << 22  # in a wide one, for memory; larger sets are ruled out less often before the sets meet
_BREAK = np.zeros(256, bool)
_BREAK[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FULL = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


PIECE = 1 << 16
_UP, _DOWN = _powers(int(_BASE), PIECE), _powers(int(_BACK), PIECE)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word; prefix hashes are held for one piece of the data at a time."""
    gap = _BREAK[data]
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    del gap
    at_start, at_end, back = (np.zeros(len(start), np.uint64) for _ in range(3))
    carry, up, down = np.uint64(0), 1, 1  # prefix hash, power and inverse power at the piece
    for o in range(0, len(data), PIECE):
        own = data[o : o + PIECE]
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum((own.astype(np.uint64) + np.uint64(7)) * _UP[: len(own)], out=sums[1:], dtype=np.uint64)
        sums = sums * np.uint64(up) + carry
        i, j = np.searchsorted(start, (o, o + PIECE))
        at_start[i:j] = sums[start[i:j] - o]
        back[i:j] = _DOWN[start[i:j] - o] * np.uint64(down)
        i, j = np.searchsorted(end, (o, o + PIECE))
        at_end[i:j] = sums[end[i:j] - o]
        carry = sums[-1]
        up, down = (up * int(_UP[-1]) * int(_BASE)) & _FULL, (down * int(_DOWN[-1]) * int(_BACK)) & _FULL
    return start, mix((at_end - at_start) * back + (end - start).astype(np.uint64))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text (A-Z in lower case)."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        raw, used, j = [], 0, i
        while j < len(texts) and (not used or used < 1 << 18):
            raw.append((texts[j] or "").encode("utf-8", "replace").lower() + b" ")
            used += len(raw[-1])
            j += 1
        start, word = _word_hashes(np.frombuffer(b" " + b"".join(raw), np.uint8))
        cuts = np.searchsorted(start, 1 + np.cumsum([0] + [len(r) for r in raw]))
        grams = np.zeros(max(len(word) - n + 1, 0), np.uint64)
        for k in range(n):
            grams = grams * _BASE + word[k : k + len(grams)]
        grams = mix(grams)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                for w in word[a:b]:
                    whole = np.uint64((int(whole) * int(_BASE) + int(w)) & _FULL)
                out.append(mix(np.array([whole])))
            else:
                out.append(np.zeros(0, np.uint64))
        i = j
    return out


class Bands:
    """Bands of sizes and the number of parts of each tile, for a threshold p / q."""

    def __init__(self, p: int, q: int):
        self.p, self.q, self.edges, self.of = p, q, [1], {}

    def _reach(self, n: int) -> None:
        while self.edges[-1] <= n:
            self.edges.append(self.edges[-1] * self.q // self.p + 1)

    def band(self, n: int) -> int:
        self._reach(n)
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def parts(self, tile: int) -> tuple[int, int]:
        """Number of parts and how many empty parts a set may have without sending them."""
        if tile in self.of:
            return self.of[tile]
        while len(self.edges) <= tile + 1:
            self._reach(self.edges[-1])
        most = self.edges[tile + 1] - 1
        differ = (most + most * self.q // self.p) * (self.q - self.p) // (self.q + self.p)
        spare = 1 + differ // 16 if differ else 0
        self.of[tile] = (differ + 1 + spare, spare)
        return self.of[tile]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Signatures of a set in its two tiles (none where only equal sets link)."""
        band, out = self.band(len(s)), []
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(s ^ _BASE), dtype=np.uint64)))
        for tile in (band, band - 1):
            k, spare = self.parts(tile) if tile >= 0 else (1, 0)
            if k == 1:
                continue
            cuts = np.searchsorted(s, _cuts(k))
            size = np.diff(cuts).astype(np.uint64)
            part = mix(sums[cuts[1:]] - sums[cuts[:-1]] + mix(np.arange(k, dtype=np.uint64) * np.uint64(1 << 20) + size + np.uint64(tile << 44)))
            empty = size == 0
            out.append(part if int(empty.sum()) > spare else part[~empty])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _cuts(k: int) -> np.ndarray:
    """Edges of k parts of the hash space."""
    cuts = np.arange(k + 1, dtype=np.uint64) * np.uint64((1 << 64) // k)
    cuts[-1] = _FULL
    return cuts


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: bit h is set if an odd number of members hash to it."""
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (64 * WORDS - 1), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_bitmap(s: np.ndarray) -> bytes | None:
    """Parity bitmap of two to four bits a member, ``MOST_BITS`` at most; none where the other has a bit a member."""
    if len(s) <= 64 * WORDS:
        return None
    bits = min(1 << (2 * len(s) - 1).bit_length(), MOST_BITS)
    return np.packbits((np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _bits(words: np.ndarray) -> np.ndarray:
    """Bits set in each row of 64-bit words; unsigned, as bitwise_count() takes the absolute value of signed ones."""
    return np.bitwise_count(words.view(np.uint64)).sum(-1).astype(np.int64)


def _differ(a: bytes, b: bytes) -> int:
    """Differing bits of two wide bitmaps; the longer one is folded, which keeps parities."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(_bits(np.bitwise_xor.reduce(y.reshape(-1, len(x))) ^ x))


def _linked(na: np.ndarray, nb: np.ndarray, common: np.ndarray, p: int, q: int) -> np.ndarray:
    return q * common >= p * (na + nb - common)


def _few(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of batches, so that few texts are in memory as Python strings."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def features(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, f0, f1 (128 bits of the set), the bitmap's words and the wide bitmap."""

    @tidied
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            sets = shingle_sets(batch.column(1).to_pylist(), n)
            size = np.array([len(s) for s in sets], np.int64)
            prints = np.array([(np.bitwise_xor.reduce(mix(s)), np.add.reduce(mix(s ^ _BASE))) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
            maps = np.array([bitmap(s) for s in sets], np.int64).reshape(-1, WORDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), *[pa.array(c) for c in prints.T], *[pa.array(c) for c in maps.T], pa.array([wide_bitmap(s) for s in sets], pa.binary())], [*names, "wide"])

    names = ["doc_id", "n", "f0", "f1", *[f"m{k}" for k in range(WORDS)]]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(read, ", ".join(f"{c} long" for c in names) + ", wide binary")


def _packed(sigs: np.ndarray, ids: np.ndarray) -> tuple[int, bytes, bytes]:
    """A message: the least id, 48 bits of each signature, and the ids above the least in 32 bits where they fit.

    Buckets go by the high bits of a signature, so the low ones tell those of a bucket apart; where they do
    not (odds of 0.002 in a bucket), a group has members that verification parts.
    """
    base, top = int(ids.min()), int(ids.max())
    own = (ids - base).astype(np.uint32) if top - base < 1 << 32 else ids
    return base, sigs.view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), own.tobytes()


def _unpacked(base: int, sigs: bytes, docs: bytes) -> tuple[np.ndarray, np.ndarray]:
    low = np.frombuffer(sigs, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :6] = low
    short = len(docs) == 4 * len(low)
    ids = np.frombuffer(docs, np.uint32).astype(np.int64) + base if short else np.frombuffer(docs, np.int64)
    return wide.view(np.uint64).ravel(), ids


def _groups(docs: DataFrame, n: int, p: int, q: int, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """(gid, doc): groups of documents that agree in a part of a tile."""
    sent = "bucket int, base long, sigs binary, docs binary"
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    @tidied
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen, held, used = Bands(p, q), {}, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                sigs = np.concatenate([s for s, _ in held])
                ids = np.repeat(np.array([d for _, d in held], np.int64), [len(s) for s, _ in held])
                rows = [(b, *_packed(sigs[i], ids[i])) for b, i in split_by(bucket_of(sigs, buckets), buckets)]
                for k in range(0, len(rows), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 1024], strict=True), types, strict=True)], ["bucket", "base", "sigs", "docs"])

        for batch in _few(batches):
            for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), n), strict=True):
                if not len(s) or doc is None:
                    continue
                key = (len(s), int(np.bitwise_xor.reduce(mix(s))), int(np.add.reduce(mix(s ^ _BASE))))
                if seen.setdefault(key, doc) != doc:
                    continue  # an equal set of this task stands for it
                sig = bands.signatures(s)
                held.append((sig, doc))
                used += len(sig)
                if used > FLUSH:
                    yield from flush()
                    held, used = [], 0
        yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        parts = [_unpacked(*x) for x in zip(*(table[c].to_pylist() for c in ("base", "sigs", "docs")), strict=True)]
        sigs, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((ids, sigs))
        sigs, ids = sigs[order], ids[order]
        del order
        fresh = np.concatenate(([True], (sigs[1:] != sigs[:-1]) | (ids[1:] != ids[:-1])))
        sigs, ids = sigs[fresh], ids[fresh]
        start = np.flatnonzero(np.concatenate(([True], sigs[1:] != sigs[:-1])))
        size = np.diff(np.append(start, len(sigs)))
        start, size = start[size > 1], size[size > 1]
        # groups of the same members have the same number
        runs = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        name = np.add.reduceat(mix(ids[runs].astype(np.uint64) + _BASE), np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
        _, kept = np.unique(name, return_index=True)
        pick = np.repeat(start[kept] - np.cumsum(size[kept]) + size[kept], size[kept]) + np.arange(int(size[kept].sum()))
        out = pa.table([pa.array(np.repeat(name[kept], size[kept]).view(np.int64)), pa.array(ids[pick])], names=["gid", "doc"])
        tidy()
        return out

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
    return slim.mapInArrow(sign, sent).groupBy("bucket").applyInArrow(meet, "gid long, doc long").distinct()


def _sets(docs: DataFrame, wanted: DataFrame, n: int, id_col: str, text_col: str, unique: bool) -> DataFrame:
    """(d, s): the sorted sets of the wanted documents (column w), as bytes of 64-bit hashes."""

    @tidied
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, 128):
            sets = shingle_sets(batch.column(1).to_pylist(), n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["d", "s"])

    slim = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    own = slim.join(wanted, F.col("d") == F.col("w"), "left_semi").mapInArrow(read, "d long, s binary").filter("length(s) > 0")
    if unique:
        return own
    return own.withColumn("f", F.xxhash64("s")).withColumn("m", F.length("s")).dropDuplicates(["d", "m", "f"]).select("d", "s")


def _dealt(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, lot, w): the documents w of the pairs, in lots of about LOT members beside a, so a hot a is spread."""
    lots = pairs.join(sizes, F.col("b") == F.col("d")).groupBy("a").agg(F.ceil(F.sum("m") / LOT).cast("long").alias("lots"))
    dealt = pairs.join(lots, "a").select("a", F.pmod(F.xxhash64("b"), F.col("lots")).alias("lot"), F.explode(F.array("a", "b")).alias("w"))
    return materialize(dealt.distinct(), "jaccard-dealt")


def _near(count: int) -> Callable[[DataFrame], DataFrame]:
    return F.broadcast if count <= NEAR else (lambda df: df)


def _narrowed(pairs: DataFrame, every: DataFrame, sizes: DataFrame, p: int, q: int, unique: bool) -> DataFrame:
    """The pairs that wide bitmaps do not rule out, for any of the texts of their ids; sets without one stay.

    A set has 16 to 32 times the bytes of its bitmap, and most pairs of large sets end here.
    ``every``: the rows of :func:`features`.
    """
    count = pairs.count()
    if not count:
        return pairs.select("a", "b")
    dealt = _dealt(pairs, sizes)
    own = every.filter("n > 0").select(F.col("doc_id").alias("d"), "n", "f0", "f1", "wide")
    placed = own.join(_near(count)(dealt), F.col("d") == F.col("w"))
    placed = (placed if unique else placed.dropDuplicates(["a", "lot", "d", "n", "f0", "f1"])).select("a", "lot", "d", "n", "wide")

    def rule_out(table: pa.Table) -> pa.Table:
        a = table["a"][0].as_py()
        rows = list(zip(*(table[c].to_pylist() for c in ("d", "n", "wide")), strict=True))
        centre, far, close = [x for x in rows if x[0] == a], set(), set()
        for doc, n, wide in rows:
            for _, m, other in centre if doc != a else []:
                most = (n + m - _differ(wide, other)) // 2 if wide and other else n  # of the overlap
                (close if _linked(n, m, min(most, n, m), p, q) else far).add(doc)
        far -= close
        return pa.table([pa.array([a] * len(far), pa.int64()), pa.array(sorted(far), pa.int64())], names=["a", "b"])

    far = placed.groupBy("a", "lot").applyInArrow(rule_out, "a long, b long")
    return materialize(pairs.select("a", "b").join(far, ["a", "b"], "left_anti"), "jaccard-narrowed")


def _verify(pairs: DataFrame, docs: DataFrame, sizes: DataFrame, n: int, p: int, q: int, id_col: str, text_col: str, unique: bool) -> DataFrame:
    """The pairs (a, b) that are linked, by intersecting the sorted sets.

    Up to ``NEAR`` pairs go to every executor, so that the texts stay where they are and a set moves
    only to the pairs it is in; more are joined by shuffle.  ``sizes``: d, m of each document.
    """
    count = pairs.count()
    if not count:
        return pairs.select("a", "b")
    near = _near(count)
    dealt = _dealt(pairs, sizes)
    sets = _sets(docs, near(dealt.select("w").distinct()), n, id_col, text_col, unique)
    placed = sets.join(near(dealt), F.col("d") == F.col("w")).select("a", "lot", "d", "s")

    def intersect(table: pa.Table) -> pa.Table:
        a, found = table["a"][0].as_py(), set()
        ids = table["d"].to_pylist()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["s"]]
        for own in [s for d, s in zip(ids, sets, strict=True) if d == a]:
            for doc, s in zip(ids, sets, strict=True):
                if doc != a and q * min(len(own), len(s)) >= p * max(len(own), len(s)):
                    at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                    if _linked(len(own), len(s), int((own[at] == s).sum()), p, q):
                        found.add(doc)
        return pa.table([pa.array([a] * len(found), pa.int64()), pa.array(sorted(found), pa.int64())], names=["a", "b"])

    return placed.groupBy("a", "lot").applyInArrow(intersect, "a long, b long")


def _bounded(pairs: DataFrame, reps: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs that the sizes and the bitmaps do not rule out."""
    side = lambda x: reps.select(F.col("doc_id").alias(x), F.col("n").alias(f"{x}_n"), *[F.col(f"m{k}").alias(f"{x}_m{k}") for k in range(WORDS)])
    differ = sum((F.bit_count(F.col(f"a_m{k}").bitwiseXOR(F.col(f"b_m{k}"))) for k in range(WORDS)), F.lit(0))
    both = F.col("a_n") + F.col("b_n")
    most = F.floor((both - differ) / 2)  # of the overlap
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(q * most >= p * (both - most)).select("a", "b").distinct()


def jaccard_components(docs: DataFrame, *, n: int = 3, p: int = 90, q: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest document reachable by links."""
    every = materialize(features(docs, n, id_col, text_col), "jaccard-sets")
    # classes of one need no join; the others are written, so the join can be split where a class is hot
    classes = every.filter("n > 0").groupBy("n", "f0", "f1").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c"))
    classes = materialize(classes.filter("c > 1").drop("c"), "jaccard-equal")
    member = every.join(classes, ["n", "f0", "f1"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), *[f"m{k}" for k in range(WORDS)])
    member = materialize(member, "jaccard-classes")
    reps = member.filter("doc_id = rep and n > 0").distinct()
    to_rep = member.filter("n > 0 and doc_id <> rep").select("doc_id", "rep").distinct()
    # an id with several texts is one document: the classes of its texts are linked
    several = member.filter("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("doc_id", "a")
    several = member.join(several, "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b"))

    members = every.agg(F.sum("n")).first()[0] or 0
    buckets = 1 + int(members * 2.2 * (1 + q / p) * (q - p) / (q + p)) // BUCKET
    groups = _groups(docs, n, p, q, id_col, text_col, buckets).join(to_rep, F.col("doc") == F.col("doc_id"), "left")
    groups = materialize(groups.select("gid", F.coalesce("rep", "doc").alias("doc")).distinct(), "jaccard-groups")
    center = groups.groupBy("gid").agg(F.min("doc").alias("a"))
    stars = groups.join(center, "gid").filter("doc <> a").select("a", F.col("doc").alias("b")).distinct()
    # where no id is repeated, no set has to be looked for twice
    unique = every.filter("n > 0 and doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty()
    sizes = every if unique else every.dropDuplicates(["doc_id", "n", "f0", "f1"])
    sizes = sizes.groupBy(F.col("doc_id").alias("d")).agg(F.sum("n").alias("m"))
    stars = _narrowed(materialize(_bounded(stars, reps, p, q), "jaccard-stars"), every, sizes, p, q, unique)
    links = _verify(stars, docs, sizes, n, p, q, id_col, text_col, unique)
    links = materialize(links.union(several), "jaccard-links")
    comp = materialize(components(links), "jaccard-components")

    # groups that the links leave in several components: the pairs across
    placed = groups.join(comp, F.col("doc") == F.col("node"), "left").select("gid", "doc", F.coalesce("component", "doc").alias("comp"))
    open_ = placed.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), F.min("doc").alias("a"))
    open_ = open_.filter("lo < hi and size > 2").select("gid", F.col("a").alias("star"), F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    rest = placed.join(open_, "gid").join(reps.withColumnRenamed("doc_id", "doc"), "doc")
    rest = rest.withColumn("t", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"))
    rest = rest.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rest = rest.select("gid", "star", "doc", "comp", "n", "t", F.least("t", "o").alias("x"), F.greatest("t", "o").alias("y"), *[f"m{k}" for k in range(WORDS)])

    def across(table: pa.Table) -> pa.Table:
        doc, comp_, size, t = (table[c].to_numpy() for c in ("doc", "comp", "n", "t"))
        star = table["star"][0].as_py()
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        maps = np.stack([table[f"m{k}"].to_numpy() for k in range(WORDS)], 1)
        a, b = [], []
        for i in np.flatnonzero((t == x) & (doc != star)):
            j = np.flatnonzero((t == y) & (comp_ != comp_[i]) & (doc != star) & ((doc > doc[i]) if x == y else True))
            differ = _bits(maps[j] ^ maps[i])
            both = size[j] + size[i]
            most = np.minimum((both - differ) // 2, np.minimum(size[j], size[i]))
            j = j[q * most >= p * (both - most)]
            a.append(np.minimum(doc[i], doc[j]))
            b.append(np.maximum(doc[i], doc[j]))
        join = lambda c: np.concatenate(c) if c else np.zeros(0, np.int64)
        tidy()
        return pa.table([pa.array(join(a)), pa.array(join(b))], names=["a", "b"])

    more = materialize(rest.groupBy("gid", "x", "y").applyInArrow(across, "a long, b long").distinct(), "jaccard-across")
    if not more.isEmpty():
        more = _narrowed(more, every, sizes, p, q, unique)
        links = links.union(_verify(more, docs, sizes, n, p, q, id_col, text_col, unique))
        comp = materialize(components(links), "jaccard-components")
    out = member.join(comp, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def _placed(docs: DataFrame, number: str) -> DataFrame | None:
    """``docs`` with a number of each row by its place in its file, or None where rows have no places of their own."""
    path, index, file, base, many = fresh_names(docs.withColumn(number, F.lit(0)), 5)
    try:
        placed = docs.withColumns({path: F.col("_metadata.file_path"), index: F.col("_metadata.row_index")})
    except AnalysisException:  # no files, or of a kind without places
        return None
    files = placed.groupBy(F.col(path).alias(file)).agg((F.max(index) + 1).alias(many))
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = materialize(files.select(file, F.coalesce(F.sum(many).over(before), F.lit(0)).alias(base)), "jaccard-files")
    rows = placed.join(F.broadcast(files), F.col(path) == F.col(file)).select(*docs.columns, (F.col(base) + F.col(index)).alias(number))
    # a join or explode() before may have made several rows of one
    return rows if rows.groupBy(number).count().filter("count > 1").isEmpty() else None


def deduplicate(docs: DataFrame, *, n: int = 5, p: int = 80, q: int = 100, id_col: str = "doc_id", text_col: str = "text", lasting: bool = False) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (rows without one come last), then the first row.

    Rows are numbered and linked by number, so each row stands for itself whatever its id:
    null and repeated ids, and repeated rows, lose and keep nothing wrongly.  ``lasting``: the
    same rows come whenever ``docs`` is read, as from a written table, so no copy is needed.
    """
    number, node, label = fresh_names(docs, 3)
    rows = _placed(docs, number) if lasting else None
    if rows is None:
        rows = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "jaccard-rows")
    found = jaccard_components(rows, n=n, p=p, q=q, id_col=number, text_col=text_col).filter("doc_id <> component_id")
    found = materialize(found.select(F.col("doc_id").alias(node), F.col("component_id").alias(label)), "jaccard-copies")
    found = found.union(found.select(label, label).distinct())
    named = found.join(rows.select(number, F.col(id_col).alias("id")), F.col(node) == F.col(number))
    kept = named.groupBy(label).agg(F.min(F.struct(F.col("id").isNull(), "id", number))[number].alias("kept"))
    gone = materialize(found.join(kept, label).filter(F.col(node) != F.col("kept")).select(node), "jaccard-gone")
    return rows.join(gone, F.col(number) == F.col(node), "left_anti").drop(number)


def op7_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)
