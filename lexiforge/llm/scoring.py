"""Language-model scoring by prediction by partial matching.

The model is a byte-context trie of order 5: for every string of up to six bytes
the training texts' count, however rare.  A byte is coded in the longest context
known; if it has not followed there, an escape leads to the next shorter context,
where the bytes of the longer one are excluded from the count.  Escapes are
estimated by method D: half a count of each distinct successor goes to the escape.
At the end stands a uniform choice among the bytes not yet excluded.  Every text is
closed by an end byte that UTF-8 never has.

The trie is never in one place.  Strings of up to three bytes are shared (256**3 at
most, whatever the corpus).  Blocks of documents send their distinct six-byte
strings with counts to reducers that own the contexts with certain last three
bytes; a reducer builds these branches and answers each block with the
log-probabilities of its own strings.  The word base is exact likewise: reducers
own the counts of all words and answer each block for its words.

Edge cases: a null or blank text has one token, its end; without training rows
all counts are zero and the model is uniform; repeated rows are scored each (and
rows that share an id are held out together); a row without an id trains;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Table, blocked, bucket_count, bucket_of, mix, sorted_docs, split_by, utf8
from .common import materialize, tidied

ORDER = 5
SHARED = 3  # bytes of the strings that all reducers know
END = 255
PART = 1 << 19
_PAD = bytes([END]) * ORDER
_REPLY = "kind string, block int, bucket int, keys binary, counts binary"


def _stream(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(_PAD + t + _PAD[:1] for t in texts), np.uint8)


def coded_keys(texts: list[bytes]) -> np.ndarray:
    """Each coded byte (those of the texts and their ends) with its ORDER bytes of context as one integer."""
    if not texts:
        return np.zeros(0, np.uint64)
    stream = _stream(texts)
    sizes = np.array([len(t) + 1 + ORDER for t in texts], np.int64)
    coded = np.ones(len(stream), bool)
    coded[((np.cumsum(sizes) - sizes)[:, None] + np.arange(ORDER)).ravel()] = False  # the padding before each text
    out, at = np.empty(len(stream) - ORDER * len(texts), np.uint64), 0
    for i in range(ORDER, len(stream), 1 << 16):  # pieces that stay in the cache
        j = min(i + (1 << 16), len(stream))
        keys = stream[i - ORDER : j - ORDER].astype(np.uint64)
        for k in range(ORDER - 1, -1, -1):
            keys <<= np.uint64(8)
            keys |= stream[i - k : j - k]
        keys = keys[coded[i:j]]
        out[at : at + len(keys)] = keys
        at += len(keys)
    return out


def count_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often they occur."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def shorter(keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts of the last ``size`` bytes of strings."""
    ends, inverse = np.unique(keys & np.uint64((1 << (8 * size)) - 1), return_inverse=True)
    return ends, np.bincount(inverse, counts, len(ends)).astype(np.int64)


class Trie:
    """Orders 0, 1, ... as arrays: strings with counts, contexts with what coding needs.

    An order is added from all its strings that end in the contexts at hand, so a
    reducer that owns some contexts can go on from the orders that all share.
    """

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.total: list[np.ndarray] = []  # occurrences of each context
        self.kinds: list[np.ndarray] = []  # its distinct successors
        self.escape: list[np.ndarray] = []  # from it, if it was entered first
        self.log_below: list[np.ndarray] = []  # weight left in the shorter context, entered from this one
        self.chain: list[np.ndarray] = []  # escapes of all shorter contexts, entered from this one

    @classmethod
    def build(cls, nodes: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
        trie = cls()
        for keys, n in nodes:
            trie.add(keys, n)
        return trie

    def copy(self) -> Trie:
        other = Trie()
        for name, value in vars(self).items():
            setattr(other, name, list(value))
        return other

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        """The next order: sorted strings and their counts."""
        k, n = len(self.keys), n.astype(np.float64)
        parent = keys >> np.uint64(8)
        starts = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1]))) if len(keys) else np.zeros(0, np.int64)
        ctx = parent[starts]
        total = np.add.reduceat(n, starts) if len(keys) else np.zeros(0)
        kinds = np.diff(np.append(starts, len(keys))).astype(np.float64)
        below, chain = np.zeros(len(ctx)), np.zeros(len(ctx))
        if k and len(keys):
            end = np.searchsorted(self.keys[k - 1], keys & np.uint64((1 << (8 * k)) - 1))
            excluded = np.add.reduceat(self.n[k - 1][end], starts)
            up = np.searchsorted(self.contexts[k - 1], ctx & np.uint64((1 << (8 * (k - 1))) - 1))
            left, fresh = self.total[k - 1][up] - excluded, self.kinds[k - 1][up] - kinds
            with np.errstate(divide="ignore"):
                below = np.where(fresh > 0, np.log(left), 0.0)
                chain = np.where(fresh > 0, np.log(0.5 * fresh) - below, 0.0) + (self.chain[k - 1][up] if k > 1 else 0.0)
        self.keys.append(keys)
        self.n.append(n)
        self.contexts.append(ctx)
        self.total.append(total)
        self.kinds.append(kinds)
        self.escape.append(np.log(0.5 * kinds) - np.log(total))
        self.log_below.append(below)
        self.chain.append(chain)

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """Natural log-probability of the last byte of each string of ORDER + 1 bytes."""
        out = np.full(len(grams), -math.log(256.0))
        todo = np.arange(len(grams))
        entered = np.zeros(len(grams), bool)  # a longer context was there
        cost, above = np.zeros(len(grams)), np.zeros(len(grams), np.int64)
        for k in range(len(self.keys) - 1, -1, -1):
            if not len(todo) or not len(self.keys[k]):
                continue
            g = grams[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            c = g >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], c), len(self.contexts[k]) - 1)
            here = self.contexts[k][at] == c
            node = np.minimum(np.searchsorted(self.keys[k], g), len(self.keys[k]) - 1)
            found = here & (self.keys[k][node] == g)
            first = here & ~entered[todo]
            then = found & ~first
            i = todo[found & first]
            out[i] = np.log(self.n[k][node[found & first]] - 0.5) - np.log(self.total[k][at[found & first]])
            i = todo[then]
            if len(i):
                a = above[i]
                out[i] = cost[i] - self.chain[k + 1][a] + np.log(self.n[k][node[then]] - 0.5) - self.log_below[k + 1][a]
            lost = here & ~found
            i = todo[lost & first]
            cost[i] = self.escape[k][at[lost & first]] + self.chain[k][at[lost & first]]
            entered[i] = True
            above[todo[lost]] = at[lost]
            todo = todo[~found]
        if len(todo) and len(self.keys) and len(self.keys[0]):
            out[todo] = np.where(entered[todo], cost[todo] - math.log(max(256 - len(self.keys[0]), 1)), -math.log(256.0))
        return out


def _deltas(ordered: np.ndarray) -> bytes:
    """Sorted keys as differences, which the shuffle compresses better."""
    return np.diff(ordered, prepend=np.uint64(0)).tobytes()


def _hash_words(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _block(table: pa.Table) -> tuple[pa.Table, list[bytes], list[list[bytes]]]:
    table = sorted_docs(table)
    texts = [t.lower() for t in utf8(table)]
    return table, texts, [t.split() for t in texts]


def _indexed(words: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words in order of appearance, the same whenever a block is read, and each word's index."""
    index: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    ids = np.fromiter(map(index.__getitem__, itertools.chain.from_iterable(words)), np.int64, sum(map(len, words)))
    return list(index), ids


def short_strings(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Strings of SHARED bytes that end at a coded byte of (text, held_out), with counts; not of held-out rows."""

    @tidied
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                texts = [(t or "").encode("utf-8", "replace").lower() for t in batch.column(0).slice(i, 256).to_pylist()]
                stream = np.frombuffer(b"".join(_PAD[:SHARED - 1] + t + _PAD[:1] for t in texts), np.uint8)
                keys = stream[SHARED - 1 :].astype(np.uint32)
                for k in range(1, SHARED):
                    keys |= stream[SHARED - 1 - k : len(stream) - k].astype(np.uint32) << np.uint32(8 * k)
                ends = np.cumsum([len(t) + SHARED for t in texts])  # what ends in the next text's padding is not coded
                coded = np.ones(len(keys), bool)
                for k in range(SHARED - 1):
                    coded[ends[:-1] - SHARED + 1 + k] = False
                held.append(count_keys(keys[coded]))
                if len(held) == 64:
                    held = [_summed(held)]
        if held:
            keys, n = _summed(held)
            for i in range(0, len(keys), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 10_000].astype(np.int64)), pa.array(n[i : i + 10_000])], ["k", "n"])

    train = rows.filter(~F.col("held_out")).select("text")
    # at most 256 ** SHARED strings whatever the corpus, and far fewer in UTF-8
    found = train.mapInArrow(read, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).orderBy("k").toArrow()
    return found["k"].to_numpy().astype(np.uint64), found["n"].to_numpy().astype(np.int64)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _owner(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a string: by its SHARED context bytes, so all longer contexts that end so are in one."""
    return bucket_of(mix((keys >> np.uint64(8)) & np.uint64((1 << (8 * SHARED)) - 1)), buckets)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out: str | None = None, block_bytes: int = 6_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    held = held_out or "crc32(cast(cast(doc_id as string) as binary)) % 5 = 1"  # an expression over doc_id
    rows, n_blocks = blocked(docs, id_col, text_col, block_bytes)
    rows = rows.withColumn("held_out", F.coalesce(F.expr(held), F.lit(False)))
    buckets = bucket_count(docs, n_blocks)
    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["kind", "block", "bucket", "keys", "counts"]

    def rows_of(out: list[tuple]) -> pa.Table:
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    keys3, n3 = short_strings(rows)
    lower = [(keys3, n3)]
    for size in range(SHARED - 1, 0, -1):
        lower.insert(0, shorter(*lower[0], size))
    shared = spark.sparkContext.broadcast(Trie.build(lower))
    n_docs = int(n3[(keys3 & np.uint64(255)) == END].sum())

    def count(table: pa.Table) -> pa.Table:
        table, texts, words = _block(table)
        block = table["block"][0].as_py()
        train = [not h for h in table["held_out"].to_pylist()]
        every, ids = _indexed(words)
        out = []
        if every:
            n = np.bincount(ids[np.repeat(train, [len(ws) for ws in words])], minlength=len(every)).astype(np.int32)
            for b, i in split_by(bucket_of(_hash_words(every), buckets), buckets):
                out.append(("word", block, b, b"\n".join([every[j] for j in i]), n[i].tobytes()))
        del words, every, ids
        mine, n_mine = count_keys(coded_keys([t for t, keep in zip(texts, train, strict=True) if keep]))
        others, _ = count_keys(coded_keys([t for t, keep in zip(texts, train, strict=True) if not keep]))
        keys = np.union1d(mine, others)
        n = np.zeros(len(keys), np.int32)
        n[np.searchsorted(keys, mine)] = n_mine
        for b, i in split_by(_owner(keys, buckets), buckets):
            out.append(("gram", block, b, _deltas(keys[i]), n[i].tobytes()))
        return rows_of(out)

    def add(table: pa.Table) -> pa.Table:
        kind, bucket, out = table["kind"][0].as_py(), table["bucket"][0].as_py(), []
        blobs = list(zip(table["block"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True))
        if kind == "word":
            total: dict[bytes, int] = {}
            for _, keys, counts in blobs:
                for w, n in zip(keys.split(b"\n"), np.frombuffer(counts, np.int32).tolist(), strict=True):
                    total[w] = total.get(w, 0) + n
            for block, keys, _ in blobs:
                out.append(("word", block, bucket, b"", np.array([total[w] for w in keys.split(b"\n")], np.int64).tobytes()))
            out.append(("vocabulary", -1, bucket, b"", np.array([sum(1 for n in total.values() if n), sum(total.values())], np.int64).tobytes()))
            return rows_of(out)
        own = [np.cumsum(np.frombuffer(k, np.uint64), dtype=np.uint64) for _, k, _ in blobs]
        keys, inverse = np.unique(np.concatenate(own), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([np.frombuffer(c, np.int32) for _, _, c in blobs]), len(keys)).astype(np.int64)
        nodes = [(keys[n > 0], n[n > 0])]
        for size in range(ORDER, SHARED, -1):
            nodes.insert(0, shorter(*nodes[0], size))
        trie = shared.value.copy()
        for ks, ns in nodes:
            trie.add(ks, ns)
        p, at = trie.log_p(keys).astype(np.float32), 0
        for (block, _, _), k in zip(blobs, own, strict=True):
            out.append(("gram", block, bucket, b"", p[inverse[at : at + len(k)]].tobytes()))
            at += len(k)
        return rows_of(out)

    sent = rows.groupBy("block").applyInArrow(count, _REPLY)
    added = materialize(sent.groupBy("kind", "bucket").applyInArrow(add, _REPLY), "lm-totals")
    vocabulary = n_words = 0
    for r in added.filter("kind = 'vocabulary'").select("counts").toLocalIterator():  # two numbers per bucket
        distinct, tokens = np.frombuffer(r["counts"], np.int64).tolist()
        vocabulary, n_words = vocabulary + distinct, n_words + tokens
    n_train, v = n_words + n_docs, vocabulary + (1 if n_docs else 0)
    below = math.log10(n_train + 0.5 * (v + 1))

    def judge(table: pa.Table, replies: pa.Table) -> pa.Table:
        table, texts, words = _block(table)
        answer = {(k, b): c for k, b, c in zip(replies["kind"].to_pylist(), replies["bucket"].to_pylist(), replies["counts"].to_pylist(), strict=True)}
        every, own = _indexed(words)
        c = np.zeros(len(every) + 1, np.int64)
        if every:
            for b, i in split_by(bucket_of(_hash_words(every), buckets), buckets):
                c[i] = np.frombuffer(answer["word", b], np.int64)
        c[-1] = n_docs
        logs = np.log10(c + 0.5) - below
        n_tokens = np.array([len(ws) + 1 for ws in words], np.int64)
        starts = np.cumsum(n_tokens) - n_tokens
        ids = np.full(int(n_tokens.sum()), len(every), np.int64)  # every text closes with the end
        inner = np.ones(len(ids), bool)
        inner[starts + n_tokens - 1] = False
        ids[inner] = own
        del words, every, own, inner
        keys = coded_keys(texts)
        distinct, _ = count_keys(keys)
        p = np.zeros(len(distinct), np.float64)
        for b, i in split_by(_owner(distinct, buckets), buckets):
            p[i] = np.frombuffer(answer["gram", b], np.float32)
        find, values = Table(distinct), np.zeros(len(keys))
        for i in range(0, len(keys), PART):
            values[i : i + PART] = p[find.find(keys[i : i + PART])]
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        out = pa.table(
            {
                "doc_id": table["doc_id"],
                "held_out": table["held_out"],
                "n_tokens": n_tokens,
                "n_known": np.add.reduceat((c[ids] > 0).astype(np.int64), starts),
                "train_tokens": np.full(len(texts), n_train, np.int64),
                "base_score": np.add.reduceat(logs[ids], starts),
                "score": np.add.reduceat(values, first) / math.log(10),
            }
        )
        return out

    replies = added.filter("kind <> 'vocabulary'").select("kind", "block", "bucket", "counts")
    return rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op2_lm_scoring(docs: DataFrame) -> DataFrame:
    return score(docs)
