"""Operator 11: phrase collocations from vertical positional lists.

A block of documents holds, per phrase, the sorted list of places where it begins.
A list is extended by one word where the phrase's place plus its length is in the
postings of a frequent word and the next place begins a frequent phrase; the
places that join are the lists of the longer phrases.  A phrase's frequency is the
length of its list over all blocks.

Frequency is decided in two ways.  A sieve per length: blocks send 32 bits of a
hash inside a bucket with the lengths of their lists (as far as they can matter),
and buckets answer which sums reach the threshold; a collision only lets a phrase
through.  Then the lists that passed every sieve are counted exactly, by their
words: a block sends them packed by bucket, and the bucket sums them.

Everything is per language: a word carries its language in the vocabulary, so
lists of two languages never meet.  Scores are exact in decimals of 38 digits
(counts below 10**17).  The best of each language come from a window that Spark
limits before the shuffle.

Defined cases: a null text has no words; a null language is ``und``; pieces of
one word have no phrases; ties of score and frequency go by the phrase's bytes;
repeated rows count each; a text of any length stays whole, in one block; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import bucket_of
from .coded import BLOCK, BUCKET, Coded, bits_of, bucket_count, coded_blocks, pair_hash, replies_of, split_sorted, table_of
from .common import materialize, tidy

LEAST, LONGEST, TOP, SCALE, COVERED = 100, 5, 2000, 1000, 100
MOST_LANGS = 100_000  # rows of a broadcast
_BREAK, _LANG = b"\xff", b"\xfe"  # bytes that UTF-8 never has
_PIECES = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_ASK = "block long, level int, bucket int, keys binary, counts binary"
_REPLY = "block long, level int, bucket int, bits binary, survivors long"
_SENT = "bucket int, lang array<string>, size array<int>, phrase array<string>, n array<long>"
_FOUND = "lang string, size int, phrase string, n long"


def tokens(text: bytes, lang: str) -> list[bytes]:
    """Lower-cased words with their language, and breaks between pieces."""
    mark = _LANG + lang.encode()
    found = text.lower().translate(_PIECES).replace(_BREAK, b" " + _BREAK + b" ").split()
    return [*(w if w == _BREAK else w + mark for w in found), _BREAK]


class Lists:
    """The positional lists of a block, length after length."""

    def __init__(self, coded: Coded, least: int, buckets: int):
        self.coded, self.least, self.buckets = coded, least, buckets
        words = np.array([w != _BREAK for w in coded.words], bool)
        self.hash = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, coded.words)), np.uint64)
        #: places of the phrases at hand in order, the phrase of each, and of each phrase its hash, first part and last word
        self.size = 1
        self.at = np.flatnonzero(words[coded.codes]) if len(coded.codes) else np.zeros(0, np.int64)
        self._number(coded.codes[self.at].astype(np.int64), lambda k: (self.hash[k], k, k))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def _number(self, keys: np.ndarray, parts) -> None:
        distinct, self.phrase, self.length = np.unique(keys, return_inverse=True, return_counts=True)
        self.key, self.head, self.last = parts(distinct)
        low = self.key & np.uint64(0xFFFFFFFF)
        self.order = np.argsort((bucket_of(self.key, self.buckets).astype(np.uint64) << np.uint64(32)) | low, kind="stable")
        self.bucket = bucket_of(self.key, self.buckets)[self.order]

    def asks(self) -> Iterator[tuple]:
        """The lengths of the lists, as far as the threshold goes; sums stay on the same side of it."""
        kind = np.uint8 if self.least <= 0xFF else np.uint32
        top = np.minimum(self.length, 0xFF if self.least <= 0xFF else 0xFFFFFFFF).astype(kind)
        low = (self.key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        for k, own in split_sorted(self.bucket):
            yield self.coded.block, self.size, k, low[self.order[own]].tobytes(), top[self.order[own]].tobytes()

    def keep(self, replies: dict[int, bytes]) -> None:
        """Only the lists that passed the sieve, numbered anew."""
        alive = np.zeros(len(self.key), bool)
        for k, own in split_sorted(self.bucket):
            alive[self.order[own]] = bits_of(replies[k], own.stop - own.start)
        number = np.cumsum(alive) - 1
        stays = alive[self.phrase]
        self.at, self.phrase = self.at[stays], number[self.phrase[stays]]
        self.key, self.head, self.last, self.length = self.key[alive], self.head[alive], self.last[alive], self.length[alive]
        if self.size == 1:  # the postings of frequent words
            self.word_at = np.full(len(self.coded.codes) + LONGEST + 1, -1, np.int64)
            self.word_at[self.at] = self.phrase
            self.words = self.head
        self.levels.append((self.head, self.last, self.length, bucket_of(self.key, self.buckets)))

    def extend(self) -> None:
        """Lists joined with the postings one phrase further on."""
        word = self.word_at[self.at + self.size]
        begins = np.zeros(len(self.coded.codes) + 1, bool)
        begins[self.at] = True
        joins = (word >= 0) & begins[np.minimum(self.at + 1, len(begins) - 1)]
        base = max(len(self.words), 1)
        keys = self.phrase[joins] * base + word[joins]
        self.at = self.at[joins]
        key, words = self.key, self.hash[self.words]
        self._number(keys, lambda k: (pair_hash(key[k // base], words[k % base]), k // base, k % base))
        self.size += 1

    def found(self) -> Iterator[tuple[int, int, bytes, bytes, int]]:
        """(bucket, size, language, phrase, length) of the lists kept."""
        before: list[tuple[bytes, bytes]] = []
        lexicon = [tuple(self.coded.words[c].split(_LANG, 1)) for c in self.words.tolist()] if self.levels else []
        for size, (head, last, length, bucket) in enumerate(self.levels, 1):
            if size == 1:
                texts = [(lang, w) for w, lang in lexicon]
            else:
                texts = [(before[h][0], before[h][1] + b" " + lexicon[w][0]) for h, w in zip(head.tolist(), last.tolist(), strict=True)]
            for k, (lang, text), n in zip(bucket.tolist(), texts, length.tolist(), strict=True):
                yield k, size, lang, text, n
            before = texts

    def totals(self) -> dict[bytes, int]:
        """Words of each language, frequent or not."""
        out: dict[bytes, int] = {}
        counts = np.bincount(self.coded.codes, minlength=len(self.coded.words)).tolist()
        for word, n in zip(self.coded.words, counts, strict=True):
            if word != _BREAK:
                lang = word.split(_LANG, 1)[1]
                out[lang] = out.get(lang, 0) + n
        return out


def phrase_counts(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK, bucket_bytes: int = BUCKET) -> DataFrame:
    """lang, size, phrase, n: all phrases of 1 to ``longest`` words met ``least`` times or more; size 0: all words of a language."""
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"longest must be 1 to {LONGEST}")
    buckets = bucket_count(docs, text_col, bucket_bytes)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    states = coded_blocks(slim, "lang", "text", tokens, "phrases-coded", block_bytes)

    def lists(table: pa.Table, replies: pa.Table | None, size: int) -> Lists:
        """The lists of ``size`` words, not yet sieved."""
        found = replies_of(replies) if replies is not None else {}
        out = Lists(Coded(table.to_pylist()[0]), least, buckets)
        while out.size < size:
            out.keep(found.get(out.size, {}))
            out.extend()
        return out

    def ask(size: int) -> DataFrame:
        if size == 1:

            def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for k in range(batch.num_rows):
                        yield from table_of(list(lists(pa.Table.from_batches([batch.slice(k, 1)]), None, 1).asks()), _ASK).to_batches()
                tidy()

            return states.mapInArrow(first, _ASK)

        def later(table: pa.Table, replies: pa.Table) -> pa.Table:
            out = table_of(list(lists(table, replies, size).asks()) if table.num_rows else [], _ASK)
            tidy()
            return out

        return states.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(later, _ASK)

    def sieve(table: pa.Table) -> pa.Table:
        kind = np.uint8 if least <= 0xFF else np.uint32
        blobs = table["keys"].to_pylist()
        keys, inverse = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in blobs]), return_inverse=True)
        counts = np.concatenate([np.frombuffer(x, kind) for x in table["counts"].to_pylist()])
        passed = (np.bincount(inverse, counts, len(keys)) >= least)[inverse]
        out, at = [], 0
        for block, level, bucket, own in zip(*(table[c].to_pylist() for c in ("block", "level", "bucket")), blobs, strict=True):
            hit = passed[at : at + len(own) // 4]
            at += len(hit)
            out.append((block, level, bucket, np.packbits(hit).tobytes(), int(hit.sum())))
        return table_of(out, _REPLY)

    told: DataFrame | None = None
    for size in range(1, longest + 1):
        reply = materialize(ask(size).groupBy("bucket").applyInArrow(sieve, _REPLY), f"phrases-{size}")
        told = reply if told is None else told.unionByName(reply)
        if not reply.agg(F.sum("survivors")).first()[0]:
            break

    def count(table: pa.Table, replies: pa.Table) -> pa.Table:
        """The exact lengths of the block's lists, packed by bucket; all words of a language go to bucket 0."""
        sent: dict[int, tuple[list, list, list, list]] = {}
        if table.num_rows:
            found = lists(table, replies, size)
            found.keep(replies_of(replies).get(size, {}))
            rows = itertools.chain(((0, 0, lang, b"", n) for lang, n in found.totals().items()), found.found())
            for bucket, k, lang, text, n in rows:
                for column, value in zip(sent.setdefault(bucket, ([], [], [], [])), (lang, k, text, n), strict=True):
                    column.append(value)
        parts = [[bucket, *columns] for bucket, columns in sent.items()]
        kinds = (pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.int64()))
        columns = [pa.array([p[k] for p in parts], kind) for k, kind in enumerate(kinds)]
        for k in (1, 3):
            columns[k] = columns[k].cast(pa.list_(pa.string()))
        tidy()
        return pa.table(columns, names=["bucket", "lang", "size", "phrase", "n"])

    def total(table: pa.Table) -> pa.Table:
        """A bucket's lengths summed over the blocks."""
        flat = pa.table({c: pa.chunked_array([x.flatten() for x in table[c].chunks], table.schema.field(c).type.value_type) for c in ("lang", "size", "phrase", "n")})
        summed = flat.group_by(["lang", "size", "phrase"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        return summed.filter((pc.field("size") == 0) | (pc.field("n") >= least)).select(["lang", "size", "phrase", "n"])

    each = states.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(count, _SENT)
    return materialize(each.groupBy("bucket").applyInArrow(total, _FOUND), "phrases-counted")


def _spans(size: str, least: int, proper: bool) -> F.Column:
    """(from, length) of the contiguous parts of a phrase of ``size`` words."""
    most = F.col(size) - 1 if proper else F.col(size)
    lengths = F.when(most >= least, F.sequence(F.lit(least), most)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(1), F.col(size) - n + 1), lambda i: F.struct(i.alias("i"), n.alias("n")))))


def collocations(counts: DataFrame, *, covered: int = COVERED, scale: int = SCALE) -> DataFrame:
    """lang, phrase, a, l, r, n, score of ``phrase_counts``: phrases of two words or more, without those that a longer one covers.

    A phrase is covered by a longer one that holds it and has ``covered`` hundredths of its frequency.
    """
    words = F.split("phrase", " ")
    phrases = counts.filter("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), words.alias("w"))
    inner = phrases.select("lang", "w", "a", F.explode(_spans("size", 2, True)).alias("s"))
    inner = inner.groupBy(F.col("lang").alias("_lang"), F.array_join(F.slice("w", F.col("s.i"), F.col("s.n")), " ").alias("_phrase")).agg(F.max("a").alias("_most"))
    same = lambda x, y: (F.col("lang") == F.col(x)) & (F.col("phrase") == F.col(y))
    open_ = phrases.join(inner, same("_lang", "_phrase"), "left").filter(F.col("_most").isNull() | (100 * F.col("_most") < covered * F.col("a")))
    cuts = open_.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    left, right = F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("_left"), right.alias("_right"))
    f = counts.filter("size >= 1")
    side = lambda name, of: f.select(F.col("lang").alias(f"_lang{name}"), F.col("phrase").alias(f"_phrase{name}"), F.col("n").alias(of))
    cuts = cuts.join(side("l", "l"), (F.col("lang") == F.col("_langl")) & (F.col("_left") == F.col("_phrasel")))
    cuts = cuts.join(side("r", "r"), (F.col("lang") == F.col("_langr")) & (F.col("_right") == F.col("_phraser")))
    totals = counts.filter("size = 0").select(F.col("lang").alias("_langn"), "n")
    if totals.count() <= MOST_LANGS:  # one short row a language: a broadcast of known size; more are joined by shuffle
        totals = F.broadcast(totals)
    cuts = cuts.join(totals, F.col("lang") == F.col("_langn"))
    big = lambda c: F.col(c).cast("decimal(17,0)")
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", "n", (F.lit(scale).cast("decimal(4,0)") * big("a") * big("n")).alias("_x"), (big("l") * big("r")).alias("_y"))
    cuts = cuts.withColumn("score", F.expr("_x div _y"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def op11_collocations(docs: DataFrame) -> DataFrame:
    found = collocations(phrase_counts(docs))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= TOP)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
