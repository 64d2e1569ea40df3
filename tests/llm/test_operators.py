"""Each operator against brute force on small tables, with the awkward cases."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiforge.llm import components, decontaminate, jaccard, langid, licenses, packing, pii, quality, scoring, sharding, suffix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, words string"


def corpus(n=60, seed=3):
    """Texts with copies, near copies, shared passages, nulls, empties, long ones and repeated rows."""
    r = random.Random(seed)
    vocab = ["the", "of", "and", "la", "der", "und", *["".join(r.choice(["ka", "ti", "on", "ré", "üb", "Sh"]) for _ in range(r.randint(1, 4))) for _ in range(300)]]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randint(1, 90))) for _ in range(n)]
    shared = " ".join(r.choice(vocab) for _ in range(30))
    for i in range(0, n, 5):
        texts[i] += "\n" + shared
    for i in range(1, n, 9):
        texts[i] = texts[0]
    for i in range(2, n, 9):
        words = texts[3].split(" ")
        words[i % len(words)] = "changed"
        texts[i] = " ".join(words)
    texts += [None, "", "  \n\t ", "one", "two words", "x" * 3000, " ".join(["again"] * 400), " ".join(r.choice(vocab) for _ in range(4000))]
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    """With extra columns whose names clash with those the operators add."""
    return spark.createDataFrame([(i, t, "en" if i % 3 else "fr", f"s{i % 4}", None, 7, "x", "y") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [(0, "x")]).filter("false")


def words(text):
    return WORD.findall(text or "")


def test_quality(docs, empty, rows):
    got = {r["doc_id"]: r for r in quality.quality_rules(docs).collect()}
    for i, t in rows:
        w, r = words(t), got[i]
        lines = [x for x in (t or "").split("\n") if words(x)]
        seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered)), i
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r["base_failed"] and r["kept"])
    assert quality.quality_rules(empty).count() == 0


def test_scoring(spark, docs, empty, rows):
    got = {r["doc_id"]: r for r in scoring.score(docs, block_bytes=4000).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    low = {i: words((t or "").translate(LOW)) for i, t in rows}
    c = Counter(w for i, ws in low.items() if not held[i] for w in [*ws, 0])
    n, v = sum(c.values()), len(c)
    for i, _ in rows:
        r, tokens = got[i], [*low[i], 0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
        assert r["score"] < 0
    one = {r["doc_id"]: r["score"] for r in scoring.score(docs).collect()}
    assert all(one[i] == pytest.approx(got[i]["score"]) for i in one)  # however the blocks fall
    assert scoring.score(empty).count() == 0


class PlainPPM:
    """Prediction by partial matching with dictionaries: method D and exclusion, order 5."""

    def __init__(self, texts):
        self.follow = defaultdict(Counter)
        for t in texts:
            s = b"\xff" * 5 + t + b"\xff"
            for i in range(5, len(s)):
                for k in range(6):
                    self.follow[s[i - k : i]][s[i]] += 1

    def p(self, context, byte):
        out, excluded = 1.0, set()
        for k in range(5, -1, -1):
            after = self.follow.get(context[5 - k :])
            if not after:
                continue
            left = {b: n for b, n in after.items() if b not in excluded}
            if left:
                total = sum(left.values())
                if byte in left:
                    return out * (left[byte] - 0.5) / total
                out *= 0.5 * len(left) / total
            excluded |= set(after)
        return out / (256 - len(excluded))

    def score(self, t):
        s = b"\xff" * 5 + t + b"\xff"
        return sum(math.log10(self.p(s[i - 5 : i], s[i])) for i in range(5, len(s)))


def test_score_is_that_of_plain_ppm(spark, rows):
    """The distributed trie against dictionaries, to the precision of 32-bit logarithms."""
    some = [r for r in rows if len(r[1] or "") < 400][:45] + [(500, None), (501, "ÀÉ zzz"), (502, "banana bandana")]
    got = {r["doc_id"]: r for r in scoring.score(frame(spark, some).repartition(3), block_bytes=3000).collect()}
    texts = {i: (t or "").translate(LOW).encode() for i, t in some}
    model = PlainPPM([t for i, t in texts.items() if not got[i]["held_out"]])
    for i, t in texts.items():
        assert got[i]["score"] == pytest.approx(model.score(t), rel=1e-5), i
    none = scoring.score(frame(spark, some), held_out="true").collect()
    assert all(r["score"] == pytest.approx(-(len(texts[r["doc_id"]]) + 1) * math.log10(256), rel=1e-5) for r in none)


def test_trie_is_a_distribution():
    texts = [t.encode() for t in ("banana bandana", "ban the banana", "a", "", "cabana")]
    nodes = [scoring.count_keys(scoring.coded_keys(texts))]
    for size in range(5, 0, -1):
        nodes.insert(0, scoring.shorter(*nodes[0], size))
    trie, plain = scoring.Trie.build(nodes), PlainPPM(texts)
    for context in (b"\xff" * 5, b"banan", b"zzzzz", b"\xff\xffban", b"ndana"):
        base = int.from_bytes(context, "big") << 8
        p = np.exp(trie.log_p(np.arange(256, dtype=np.uint64) + np.uint64(base)))
        assert p.sum() == pytest.approx(1.0, abs=1e-9), context
        assert p == pytest.approx([plain.p(context, b) for b in range(256)])


def test_packing(spark, docs, empty, rows):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = [*rows, (900, "a <|endoftext|> b"), (901, "<|endoftext|>"), (902, "x<|endoftext|>  y\n")]
    docs = frame(spark, rows)
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, group_docs=16).collect():
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty).count() == 0


def test_best_fit_decreasing():
    r = random.Random(1)
    lengths = sorted((r.randint(1, 100) for _ in range(400)), reverse=True)
    bins, offsets = packing.best_fit_decreasing(lengths, 100)
    room, want = [], []
    for n in lengths:  # brute force
        fits = [(c, k) for k, c in enumerate(room) if c >= n]
        if fits:
            want.append(min(fits)[0])
            room[min(fits)[1]] -= n
        else:
            want.append(100)
            room.append(100 - n)
    assert [100 - o for o in offsets] == want and max(bins) + 1 == len(room)


def test_sharding(docs, empty, spark, rows):
    got = sharding.op5_sharding(docs).collect()
    assert len(got) == len(rows)
    text, by = dict(rows), defaultdict(list)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        by[r["shard"]].append((r["slot"], r["size"]))
    assert set(by) <= set(range(40)) and all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values())
    heavy = max(s for v in by.values() for _, s in v)
    sums = [sum(s for _, s in by.get(k, [])) for k in range(40)]
    assert max(sums) - min(sums) <= heavy + sum(sums) / 40 / 16
    r = random.Random(4)
    mixed = [(i, "x" * r.choice((10, 50, 400))) for i in range(4000)] + [(9000 + i, "y" * 30_000) for i in range(3)] + [(9000, "y" * 30_000), (None, "z" * 9_000), (None, "z" * 9_000)]
    placed = sharding.shard(spark.createDataFrame(mixed, "doc_id long, text string"), 10).collect()
    sums, slots = Counter(), defaultdict(list)
    for x in placed:
        sums[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
    assert Counter((x["doc_id"], x["text"]) for x in placed) == Counter(mixed) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len(sums) == 10 and max(sums.values()) - min(sums.values()) <= 2 * 416
    same = spark.createDataFrame([(i, "copy") for i in range(3000)], "doc_id long, text string")  # one hot group
    counts = [r["count"] for r in sharding.shard(same, 8, ranges=16).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
    assert sharding.op5_sharding(empty).count() == 0
    clash = sharding.shard(spark.createDataFrame([(1, "a", 5, 6, 7)], "doc_id long, text string, _h long, row long, r long"), 2)
    assert clash.columns == ["doc_id", "text", "_h", "row", "r", "size", "shard", "slot"] and tuple(clash.first())[2:6] == (5, 6, 7, 17)


def brute_suffix(rows, length=50):
    first, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("block_bytes", [2500, 10**9])
def test_suffix(docs, rows, block_bytes):
    got = suffix.deduplicate(docs, block_bytes=block_bytes).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute_suffix(rows)


def test_anchors_depend_on_the_window_alone():
    """Equal windows have equal anchors at equal offsets, however the parts fall and however short the hashes."""
    r = random.Random(12)
    shared = bytes(r.choice(b"abcd") for _ in range(400))
    texts = [bytes(r.choice(b"abcd") for _ in range(r.randint(0, 700))) + shared for _ in range(6)] + [b"short", b""]
    for part in (100, 1000, 1 << 18):
        for keep in (64, 26, 22):
            stream, starts, a = suffix.anchors(texts, part=part, keep=keep)
            seen, windows = {}, set()
            for f, e, at in zip(a.first.tolist(), a.last.tolist(), a.at.tolist(), strict=True):
                for w in range(f, e + 1):
                    assert seen.setdefault(stream[w : w + 50].tobytes(), at - w) == at - w
                    assert w not in windows
                    windows.add(w)
            assert len(windows) == sum(max(len(t) - 49, 0) for t in texts)
    with pytest.raises(ValueError):
        suffix.deduplicate(None, length=80)


def test_suffix_edges(spark, empty):
    assert suffix.op6_suffix_dedup(empty).count() == 0
    twice = [(1, "z" * 60), (1, "z" * 60), (2, "y" + "z" * 50)]
    got = sorted(tuple(r)[:4] for r in suffix.op6_suffix_dedup(frame(spark, twice)).collect())
    assert got == [(1, 60, 0, 0), (1, 60, 0, 0), (2, 51, 50, 1)]


def test_suffix_sort():
    r = random.Random(5)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 30))) for _ in range(300)]
    group = np.sort(np.array([r.randint(0, 9) for _ in strings]))
    size = np.array([len(s) for s in strings])
    s = suffix.Suffixes(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size)
    assert [(group[i], strings[i]) for i in s.sort(group)] == sorted(zip(group.tolist(), strings, strict=True))


def brute_jaccard(rows, n, p, q):
    sets = {}
    for i, t in rows:
        w = words((t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    moved = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b])]
    while moved:
        moved = False
        for a, b in links:
            low = min(comp[a], comp[b])
            moved |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return {i: (len(sets[i]), comp[i]) for i in sets}


@pytest.mark.parametrize(("n", "p"), [(3, 90), (5, 80)])
def test_jaccard(docs, rows, n, p):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, n=n, p=p).collect()}
    assert got == brute_jaccard(rows, n, p, 100)


def test_jaccard_across_and_hot(spark, empty):
    """A chain whose ends are far apart, copies, and links not through the smallest member."""
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(14):
        w = list(base)
        for j in range(k):
            w[(4 * j) % 60] = f"e{j}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts + texts[:5] * 40))
    random.Random(2).shuffle(rows)
    for p in (90, 80):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame(spark, rows), n=3, p=p).collect()}
        assert got == brute_jaccard(rows, 3, p, 100)
    assert jaccard.op7_jaccard_join(empty).count() == 0
    kept = jaccard.deduplicate(frame(spark, rows), n=3, p=90)
    assert kept.columns == frame(spark, rows).columns and kept.count() == len({c for _, c in brute_jaccard(rows, 3, 90, 100).values()})


def test_jaccard_moves_little(spark, monkeypatch):
    """A pair's check sends sets to pairs only, texts and sets to no join, and gives the same by shuffle."""
    rows = [(i * 2**40 - 7, t) for i, t in corpus(40)]
    docs, pairs = frame(spark, rows), spark.createDataFrame([(rows[3][0], rows[2][0]), (rows[0][0], rows[1][0]), (rows[0][0], rows[4][0])], "a long, b long")
    sizes = docs.selectExpr("doc_id as d", "1L as m")
    found = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    for near in (jaccard.NEAR, 0):
        monkeypatch.setattr(jaccard, "NEAR", near)
        links = jaccard._verify(pairs, docs, sizes, 3, 90, 100, "doc_id", "text", True)
        plan = links._jdf.queryExecution().executedPlan().toString()
        found[near] = sorted(map(tuple, links.collect())), plan.count("Exchange hashpartitioning")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (links, moves), (same, more) = found.values()
    assert links == same and (rows[0][0], rows[1][0]) in links and (rows[0][0], rows[4][0]) not in links
    assert moves <= 2 < more  # the pairs' distinct documents and the groups of pairs
    ids = np.array([5, -(2**62), 2**62, 5], np.int64)
    sigs = np.arange(4, dtype=np.uint64)
    for own in (ids, ids[[0, 3]], ids[:1] + 2**31):
        s, d = jaccard._unpacked(*jaccard._packed(sigs[: len(own)], own))
        assert (s == sigs[: len(own)]).all() and (d == own).all()


def test_signatures_guarantee():
    """Linked sets share a signature, whatever their sizes."""
    r = np.random.default_rng(4)
    for p in (90, 80):
        bands = jaccard.Bands(p, 100)
        for n in (10, 11, 19, 40, 77, 300):
            for _ in range(20):
                a = np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
                b = a
                while True:  # drift as far as the link holds
                    c = np.unique(np.concatenate((np.delete(b, r.integers(len(b))), r.integers(0, 2**63, int(r.integers(2))).astype(np.uint64))))
                    common = len(np.intersect1d(a, c))
                    if 100 * common < p * (len(a) + len(c) - common):
                        break
                    b = c
                assert np.array_equal(a, b) or len(np.intersect1d(bands.signatures(a), bands.signatures(b)))


def test_components(spark):
    r = random.Random(8)
    edges = [(r.randint(0, 200), r.randint(0, 200)) for _ in range(120)] + [(500 + k, 501 + k) for k in range(40)]
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long").repartition(4)).collect()}
    root = {v: v for e in edges for v in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {v: c for v, c in root.items() if any(v in e and e[0] != e[1] for e in edges)}


def test_decontamination(spark, docs, empty):
    r = random.Random(6)
    item = [f"q{r.randint(0, 10**6)}" for _ in range(40)]
    edit = [*item[:1], "zz", *item[2:]]
    hay = [f"h{r.randint(0, 10**6)}" for _ in range(100)]
    rows = [
        (1, " ".join([*hay[:20], *item, *hay[20:]])), (2, " ".join(item).upper() + "!!"), (3, " ".join(hay)), (4, " ".join([*hay[:7], *edit])),
        (5, " ".join([*hay[:9], *item[:15], *hay[9:]])), (6, None), (7, ""), (8, " ".join(f"{w}***" for w in item)),
    ]
    bench = spark.createDataFrame([(9, " ".join(item)), (10, "too short"), (11, None)], "item_id long, text string")
    for limit in (1_000_000, 0):  # broadcast, or shuffled on both sides
        got = {(x["doc_id"], x["item_id"], x["start"]): round(x["similarity"], 3) for x in decontaminate.leaks(frame(spark, rows), bench, broadcast_rows=limit).collect()}
        assert got == {(1, 9, 20): 1.0, (2, 9, 0): 1.0, (4, 9, 7): round(34 / 38, 3), (8, 9, 0): 1.0}
    short = [(50, "Two  words!"), (51, "say two words now"), (52, "two other words"), (53, " ".join([*hay[:9], "two", "words", *item]))]
    for limit in (1_000_000, 0):  # items of fewer words than a shingle are matched whole
        more = spark.createDataFrame([(9, " ".join(item)), (10, "two words"), (11, "!"), (12, "two words")], "item_id long, text string")
        got = {(x["doc_id"], x["item_id"], x["start"], x["similarity"]) for x in decontaminate.leaks(frame(spark, short), more, broadcast_rows=limit).collect()}
        assert got == {(d, i, s, 1.0) for i in (10, 12) for d, s in ((50, 0), (51, 1), (53, 9))} | {(53, 9, 11, 1.0)}
    left = decontaminate.decontaminate(frame(spark, rows), bench)
    assert left.columns == docs.columns and {x["doc_id"] for x in left.collect()} == {3, 5, 6, 7}
    assert decontaminate.leaks(empty, bench).count() == 0 and decontaminate.leaks(docs, bench.filter("false")).count() == 0


FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
        "card": lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    return sorted((m.start(), k, m.end()) for k, name in enumerate(FORMS) for m in FORMS[name].finditer(text or "") if ok[name](m.group()))


def pii_rows():
    r = random.Random(9)
    parts = ["é a@b.co", "x.y+z@d-e.f.g", "a@b.c_d@e.f", "@no", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "0007.1.2.03", "+1 (555) 123-4567", "+12", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "😀", "+4917612345678", "12345678901234567890", "a..b@c..d", "\n"]
    rows = [(i, " ".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for i in range(80)]
    rows += [(90, None), (91, ""), (92, "9" * 5000), (93, "a" * 20000 + "@"), (94, ".1" * 4000), (95, "x@y" + ".z" * 9000), (96, "+1" + " 2" * 3000)]
    return rows


def test_pii_base(spark, empty):
    got = {r["doc_id"]: r for r in pii.op9_pii(frame(spark, pii_rows())).collect()}
    names = list(FORMS)
    for i, t in pii_rows():
        want = brute_pii(t)
        text = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in want)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (i, t, want, r["spans"])
        assert [r[f"n_{n}"] for n in names] == [sum(k == j for _, j, _ in want) for k in range(4)]
        assert {x for x in text.split(",") if x} <= set(r["spans"].split(","))
    assert pii.op9_pii(empty).count() == 0


@pytest.mark.parametrize("texts", [1, 8, 1000])
def test_pii_bootstrap_and_redaction(spark, texts, monkeypatch):
    monkeypatch.setattr(pii, "BOUND_TEXTS", texts)
    h = lambda k: hashlib.md5(str(k).encode()).hexdigest()
    rows = [(i, f"so password={h(i)} here") for i in range(40)] + [(100 + i, f'my token = "{h(i + 900)}" then {i} and word{i}') for i in range(30)] + [(200, "room 12345 of 1999 is clean"), (201, None)]
    d = frame(spark, rows)
    spans = {r["doc_id"]: r["spans"] for r in pii.op9_pii(d).collect()}
    assert all(re.fullmatch(r"id:\d+:\d+", spans[i]) for i, _ in rows[:70]) and spans[200] == spans[201] == ""
    out = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert out[0] == "so password=<ID> here" and out[105] == 'my token = "<ID>" then 5 and word5' and out[200] == rows[70][1] and out[201] is None
    assert pii.redact(d).columns == d.columns


def test_language(spark, empty):
    r = random.Random(11)
    parts = {"en": ["the", "tion", "ing", "wh", "of"], "de": ["sch", "ung", "der", "ßen", "ü"], "fr": ["eau", "tion", "ée", "que", "la"]}
    make = lambda k: " ".join("".join(r.choice(parts[k]) for _ in range(r.randint(1, 3))) for _ in range(60))
    truth = {i: ["en", "de", "fr"][i % 3] for i in range(300)}
    rows = [(i, make(k), k if i % 2 else None, f"h{i % 3}", 0, 0, "", "") for i, k in truth.items()]
    rows += [(1000, None, "en", "h0", 0, 0, "", ""), (1001, " 12 ", "en", "h0", 0, 0, "", ""), (1002, make("de"), "en", "h1", 0, 0, "", "")]
    got = {x["doc_id"]: x for x in langid.op10_language_id(spark.createDataFrame(rows, SCHEMA)).collect()}
    right = sum(got[i]["lang"] == k for i, k in truth.items() if i % 2 == 0)  # rows without a declaration
    assert right / 150 > 0.98 and all(got[i]["kept"] for i in truth)
    assert not got[1000]["kept"] and not got[1001]["kept"] and got[1002]["lang"] == "de"
    assert langid.op10_language_id(empty).count() == 0
    page = spark.createDataFrame([(1, "http://a.b.de/x", '<html lang="DE"><style>p{}</style><p>Hallo</p>'), (2, None, None)], "page_id long, url string, html string")
    first, second = langid.page_evidence(page).orderBy("doc_id").collect()
    assert (first["declared"], first["host"], first["suffix"], first["text"].split()) == ("de", "a.b.de", "de", ["Hallo"]) and second["host"] is None


def test_language_evidence(spark):
    """A rare language is modelled, an undeclared one is rejected, and pages fuse markup, host and suffix."""
    r = random.Random(5)
    make = lambda parts: " ".join("".join(r.choice(parts) for _ in range(3)) for _ in range(60))
    en, fi, ru = ["the", "ing", "of", "wh"], ["kka", "yö", "ää", "inen"], ["ство", "ния", "ый", "щи"]
    rows = [(i, make(en), "en-GB", "h0", 0, 0, "", "") for i in range(400)] + [(900, make(fi), "FI", "h0", 0, 0, "", ""), (901, make(fi), None, "h0", 0, 0, "", "")]
    rows += [(902, make(ru), None, "h0", 0, 0, "", ""), (903, make(en), "no code", "h0", 0, 0, "", "")]
    got = {x["doc_id"]: x for x in langid.op10_language_id(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[900]["lang"] == got[901]["lang"] == "fi" and got[0]["lang"] == got[903]["lang"] == "en"
    assert got[902]["lang"] is None and not got[902]["kept"]
    page = lambda i, k, host, parts: (i, f"https://{host}/p{i}", f'<html{k}><body><p>{make(parts)}</p></body></html>')
    both = lambda: " ".join([make(en)[:40], make(fi)[:40]])
    pages = [page(i, ' lang="en"', f"a{i % 3}.example.com", en) for i in range(40)] + [page(100 + i, ' lang="fi"', f"b{i % 3}.example.fi", fi) for i in range(40)]
    pages += [(200 + k, f"http://x.example.{s}/", f"<p>{both()}</p>") for k, s in enumerate(["fi", "com"])] + [(300, None, None)]
    found = {x["page_id"]: x["lang"] for x in langid.language_of_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(found[i] == "en" and found[100 + i] == "fi" for i in range(40)) and found[300] is None and len(found) == 83


def test_licenses(spark, docs, empty):
    rows = [(1, "hay\nReleased under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0."), (3, "a driver's license of the city"), (4, None), (5, ""),
            (6, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License."), (7, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0")]
    got = {r["doc_id"]: (r["n_paragraphs"], r["families"]) for r in licenses.op4_license_scan(frame(spark, rows)).collect()}
    assert got == {1: (3, "MIT"), 2: (1, "CC-BY-NC"), 3: (1, ""), 4: (0, ""), 5: (0, ""), 6: (2, "GPL,MIT"), 7: (1, "Apache-2.0")}
    assert licenses.op4_license_scan(docs).filter("n_licenses > 0").count() == 0 and licenses.op4_license_scan(empty).count() == 0


def test_licence_classifier_held_out():
    """Unseen wordings around known notices, and prose."""
    m = licenses.fit()
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            if len(t.split()) > 3:
                assert m.predict(licenses._words(("Please note that this file is " + t + " see the project page").encode()))[0] in (family, licenses.UNKNOWN)
    hits = [m.predict(licenses._words(("Our module is " + texts[0]).encode()))[0] == f for f, texts in licenses.TEMPLATES.items()]
    assert sum(hits) >= 0.85 * len(hits)
    assert all(m.predict(licenses._words(t.encode()))[0] == licenses.UNKNOWN for t in licenses.CONFUSERS)


def test_rows_without_id(spark):
    """Nulls in every column: defined, and no crash."""
    text = "mail a@b.co or " + " ".join(f"word{k}" for k in range(60))
    rows = [(None, text), (1, text), (2, text + " more"), (None, None)]
    d = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)
    assert quality.quality_rules(d).count() == 4 and sharding.op5_sharding(d).count() == 4
    assert scoring.score(d).count() == 4 and langid.op10_language_id(d).count() == 4 and licenses.op4_license_scan(d).count() == 4
    gone = {r["doc_id"]: r["n_removed"] for r in suffix.op6_suffix_dedup(d.filter("text is not null")).collect()}
    assert gone == {None: len(text), 1: 0, 2: len(text)}
    comp = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.op7_jaccard_join(d).collect()}
    assert comp[(None, 61)] == 1 and comp[(2, 62)] == 1 and comp[(None, 0)] is None
    assert [r["text"] for r in pii.redact(d.filter("doc_id is null and text is not null")).collect()] == [text.replace("a@b.co", "<EMAIL>")]
    bench = spark.createDataFrame([(None, text)], "item_id long, text string")
    assert decontaminate.leaks(d, bench).count() == 3


def test_pii_bootstrap_from_base_spans(spark):
    """Seeds with separators teach contexts; what else stands there is found, with its separators, and nowhere else if it is a plain word."""
    rows = [(i, f"so contact: user{i}@mail{i}.org <now> bye{i}") for i in range(30)] + [(100 + i, f"so contact: user{i}(at)x then") for i in range(2)]
    rows += [(200, "so contact: someone/else <now> fine"), (201, "a plain someone and else"), (202, f'my token = "{"ab12" * 10}" here'), (203, f"again {'ab12' * 10}"), (204, "token = parser and secret: nothing")]
    d = frame(spark, rows)
    out = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert out[0] == "so contact: <EMAIL> <now> bye0" and out[200] == "so contact: <ID> <now> fine"
    assert out[202] == 'my token = "<ID>" here' and out[203] == "again <ID>"
    assert out[201] == dict(rows)[201] and out[204] == dict(rows)[204]


def test_wrapped_licences(spark):
    """Notices over several lines, with comment marks, are found at their first line; a blank line ends a paragraph."""
    wrap = lambda t, mark: "\n".join(mark + x for x in textwrap.wrap(t, 34))
    long = [(f, t) for f in ("MIT", "BSD", "ISC", "GPL") for t in licenses.TEMPLATES[f] if len(t) > 90]
    rows = [(i, "some prose about a bridge\n\n" + wrap(t, mark) + "\n\nand more of it") for i, (t, mark) in enumerate((t, mark) for _, t in long for mark in ("", " * ", "# "))]
    rows += [(100, "Permission is hereby granted, free of charge,\n\nto any person obtaining\n\nwithout restriction"), (101, "the general release of the software\nto the public of the city\nin version two")]
    got = {r["doc_id"]: (r["families"], r["paragraphs"].split(",")) for r in licenses.op4_license_scan(frame(spark, rows)).collect()}
    for i in range(3 * len(long)):
        assert got[i][0] == long[i // 3][0] and got[i][1][0].split(":")[0] in ("2", "3"), (rows[i], got[i])
    assert got[100][0] == got[101][0] == ""


def test_pii_many_matches(spark):
    """A text of 100,000 matches takes seconds, and clashing names pass through."""
    import time

    text = " ".join(f"10.{i % 256}.{i // 256 % 256}.7" for i in range(100_000)) + " é😀 tail"
    d = spark.createDataFrame([(1, text, "spans", 5), (2, "plain", "x", 6), (3, None, None, None)], "doc_id long, text string, spans string, _c0 int")
    began = time.time()
    r = {x["doc_id"]: x for x in pii.op9_pii(d).collect()}
    assert r[1]["n_ip"] == 100_000 and r[2]["spans"] == ""
    want = ",".join(f"ip:{m.start()}:{m.end()}" for m in FORMS["ip"].finditer(text))
    assert r[1]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    out = {x["doc_id"]: (x["text"], x["spans"], x["_c0"]) for x in pii.redact(d).collect()}
    assert out == {1: ("<IP> " * 100_000 + "é😀 tail", "spans", 5), 2: ("plain", "x", 6), 3: (None, None, None)}
    assert time.time() - began < 90


def test_licence_recall_and_denials():
    """Held-out wordings: precision and recall of every family, and sentences that deny or ask."""
    m = licenses.fit()
    frames = ["Our code is distributed as follows: {}", "{} - see the file COPYING", "NOTICE {} (all files)", "/* {} */", "Unless stated otherwise: {}"]
    hit, said, true = Counter(), Counter(), Counter()
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            for f in frames:
                got = m.predict(licenses._words(f.format(t).encode()))[0]
                true[family] += 1
                said[got] += 1
                hit[family] += got == family
    recall = {f: hit[f] / true[f] for f in true}
    precision = {f: hit[f] / said[f] for f in true if said[f]}
    assert min(precision.values()) >= 0.95 and sum(hit.values()) / sum(true.values()) >= 0.9 and min(recall.values()) >= 0.7, (recall, precision)
    denied = ["I would never put my work under {} today", "this package isn't licensed under {}", "whether to choose {} or not is up to you", "do not assume that {} applies"]
    wrong = [d.format(n) for d in denied for n in licenses.NAMES.values() if m.predict(licenses._words(d.format(n).encode()))[0] != licenses.UNKNOWN]
    assert len(wrong) <= 0.05 * len(denied) * len(licenses.NAMES), wrong


def test_decontamination_all_windows(spark):
    """Edited, reordered, cut and repeated items against every window of an item's size: recall 1 on 150 texts."""
    r = random.Random(12)
    items = [[f"v{r.randint(0, 400)}" for _ in range(n)] for n in (15, 16, 22, 31, 40, 58)] + [["a"] * 17, ["x", "y"], ["solo"]]
    rows = []
    for k in range(150):
        item = list(items[k % len(items)])
        for _ in range(r.randint(0, 2) if len(item) > 2 else 0):
            at = r.randrange(len(item))
            item[at : at + r.randint(0, 1)] = [f"e{k}"] * r.randint(0, 1)
        if k % 7 == 0:  # halves swapped
            item = item[len(item) // 2 :] + item[: len(item) // 2]
        if k % 11 == 0:
            item = item + item
        rows.append((k, " ".join([f"h{r.randint(0, 50)}" for _ in range(r.choice((0, 3, 30)))] + item + [f"h{r.randint(0, 50)}" for _ in range(r.choice((0, 2, 30)))])))

    def shingled(w):
        return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1)))

    want = {}
    for k, t in rows:
        w = t.split()
        for j, item in enumerate(items):
            b, n = shingled(item), len(item)
            for s in range(max(len(w) - n, 0) + 1):
                a = shingled(w[s : s + n])
                sim = sum((a & b).values()) / sum((a | b).values())
                if sim >= 0.8 and sim > want.get((k, j), (0, 0))[0]:
                    want[k, j] = (sim, s)
    bench = spark.createDataFrame([(j, " ".join(x)) for j, x in enumerate(items)], "item_id long, text string")
    for limit in (1_000_000, 0):
        got = {(x["doc_id"], x["item_id"]): (x["similarity"], x["start"]) for x in decontaminate.leaks(frame(spark, rows), bench, broadcast_rows=limit).collect()}
        assert len(want) > 60 and set(want) <= set(got)
        assert all(got[p][0] >= want[p][0] - 1e-9 for p in want) and all(got[p] == pytest.approx(want[p]) for p in want if got[p][0] <= want[p][0] + 1e-9)


def test_hamming_blocks_and_radius(spark):
    """All pairs within the radius pass the blocks, as brute force has them; similar windows are hardly ever further away."""
    r = random.Random(3)
    near = []
    for _ in range(600):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, 40)):
            b ^= 1 << bit
        near.append((a, b))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for radius in (0, 7, 15, decontaminate.RADIUS):
        left = spark.createDataFrame([(k % 3, signed(a)) for k, (a, _) in enumerate(near)], "n int, fp long")
        right = spark.createDataFrame([(k % 3, signed(b)) for k, (_, b) in enumerate(near)], "n int, item_fp long")
        got = {tuple(x) for x in decontaminate.near_fingerprints(left, right, radius).collect()}
        assert got == {(k % 3, signed(a), signed(b)) for k, (a, _) in enumerate(near) for j, (_, b) in enumerate(near) if k % 3 == j % 3 and (a ^ b).bit_count() <= radius}
    rng, far, tried = np.random.default_rng(5), 0, 0
    for n in (14, 20, 30, 40, 60):  # words changed at both ends, where a change costs the fewest shingles
        lost = max(k for k in range(n) if (n - 4 - k) / (n - 4 + k) >= 0.8)
        bits = rng.integers(0, 2, (4000, n + lost, 64), dtype=np.int8)
        one, two = (2 * bits[:, i : i + n].sum(1) > n for i in (0, lost))
        far += int(((one != two).sum(1) > decontaminate.RADIUS).sum())
        tried += 4000
    assert far <= 3 * tried / 10_000, far / tried  # 1 in 12,000 over 120,000 windows
