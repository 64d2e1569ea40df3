"""Phrases and repeated windows against brute force, with small blocks so that lists and windows meet across blocks."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiforge.llm import phrases, substrings

SCHEMA = "doc_id long, text string, lang string, n long, size int, block long, phrase string"
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def corpus(seed=4, n=120):
    r = random.Random(seed)
    vocab = ["The", "of", "été", "Über", "a", "b", "c", "\x85x", "d e", "and"]
    shared = [" ".join(r.choice(vocab) for _ in range(k)) for k in (12, 13, 14, 30, 70)]
    texts = []
    for i in range(n):
        words = [r.choice(vocab[: r.choice((3, 10))]) + r.choice(["", "", "", ",", "."]) + r.choice(["", "", str(r.randint(0, 400))]) for _ in range(r.randint(0, 60))]
        words.insert(r.randint(0, len(words)), r.choice([*shared, "", "", ""]))
        texts.append(r.choice([" ", " ", "\t", "\n", "  "]).join(words))
    texts += [None, "", " \n", "one", texts[0], texts[0], " ".join(["same"] * 40), " ".join(f"w{i}" for i in range(20000))]
    return [(r.choice([i, i, i, i // 2, None]), t, r.choice(["en", "en", "fr", None])) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, 3, "x") for i, t, lang in rows], SCHEMA).repartition(4)


def counted(rows, least):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return n, {p: a for p, a in f.items() if a >= least}


def ranked(rows, least):
    n, f = counted(rows, least)
    out = []
    for (lang, w), a in f.items():
        longer = any(x != w and lang == g and 100 * b >= 100 * a and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1)) for (g, x), b in f.items() if len(x) > len(w))
        if len(w) > 1 and not longer:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return sorted(out)


@pytest.mark.parametrize("least", [2, 5, 300])
def test_collocations(spark, least):
    rows = corpus()
    counts = phrases.phrase_counts(frame(spark, rows), least=least, block_bytes=3000, bucket_bytes=20000)
    assert sorted(tuple(r) for r in phrases.collocations(counts).select("lang", "phrase", "a", "l", "r", "n", "score").collect()) == ranked(rows, least)


def test_counts_beyond_64_bits(spark):
    big = 9 * 10**15
    counts = spark.createDataFrame([("en", 0, "", big), ("en", 1, "x", big), ("en", 1, "y", big - 1), ("en", 2, "x y", big - 2)], "lang string, size int, phrase string, n long")
    got = phrases.collocations(counts).first()
    assert got["score"] == 1000 * (big - 2) * big // (big * (big - 1))


def test_rank_and_empty(spark):
    rows = [(i, "Aa bb cc. Dd ee, " * 3, "en") for i in range(40)]
    got = [tuple(r) for r in phrases.op11_collocations(frame(spark, rows)).orderBy("rank").select("rank", "phrase", "a", "score").collect()]
    assert got == [(1, "aa bb cc", 120, 5000), (2, "dd ee", 120, 5000)]
    assert phrases.op11_collocations(frame(spark, rows).filter("false")).count() == 0


def removed(rows, size):
    """(id, words, removed, digest) by looking at every window."""
    big = 1 << 63
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t, _ in rows]
    ids = [big if i is None else i for i, _, _ in rows]
    first = {}
    for i, w in zip(ids, words, strict=True):
        for s in range(len(w) - size + 1):
            g = tuple(w[s : s + size])
            first[g] = min(first.get(g, big), i)
    out = []
    for i, w in zip(ids, words, strict=True):
        gone = {s + k for s in range(len(w) - size + 1) if first[tuple(w[s : s + size])] < i for k in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((None if i == big else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("size", "block", "bucket"), [(13, 2000, 9000), (13, 8_000_000, 16_000_000), (5, 2000, 9000), (1, 3000, 9000), (50, 2000, 3000)])
def test_repeated_windows(spark, size, block, bucket):
    rows = corpus(seed=size)
    got = substrings.deduplicate(frame(spark, rows), words=size, block_bytes=block, bucket_bytes=bucket)
    got = got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter(removed(rows, size))


def test_no_window_survives(spark):
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(30)), "en") for i in range(9)]
    got = substrings.op12_substring_dedup(frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == Counter(removed(rows, 13))
    assert substrings.op12_substring_dedup(frame(spark, rows).filter("false")).count() == 0


def test_lengths_at_most_double():
    for size in range(1, 200):
        found = substrings.lengths(size)
        assert found[0] == 1 and found[-1] == size and all(a < b <= 2 * a for a, b in zip(found, found[1:], strict=False))
