"""Near duplicates: links that the stars leave over, large sets, and rows that are not copied."""

import glob

import numpy as np
import pytest

from lexiforge.llm import jaccard
from lexiforge.llm.common import materialize, scratch_root


def _words(n):
    words = [f"w{k}" for k in range(n)]
    return words, np.array([s[0] for s in jaccard.shingle_sets(words, 1)])


def _left_over():
    """Texts s, a, b: a and b are linked, s with neither, and wherever a and b agree in a part, s does too."""
    words, hashes = _words(20_000)
    bands = jaccard.Bands(80, 100)
    tiles = [bands.parts(t)[0] for t in (bands.band(100), bands.band(100) - 1)]
    part = np.stack([np.searchsorted(jaccard._cuts(k), hashes, "right") for k in tiles], 1)
    for seed in range(1000):
        pick = np.random.default_rng(seed).permutation(len(words))
        core, a, b, rest = pick[:90], pick[90:100], pick[100:110], pick[110:]
        own = np.concatenate((a, b))
        moved = lambda x: np.isin(part[x, 0], part[own, 0]) & np.isin(part[x, 1], part[own, 1])  # noqa: E731, B023
        gone, new = core[moved(core)][:12], rest[moved(rest)][:22]
        if len(gone) < 12:
            continue
        sets = [np.concatenate((core[~np.isin(core, gone)], new)), np.concatenate((core, a)), np.concatenate((core, b))]
        maps = [jaccard.bitmap(np.sort(hashes[x])) for x in sets]
        if (maps[1] ^ maps[2]).min() < 0:
            return [" ".join(words[k] for k in x) for x in sets]
    raise AssertionError("no such texts")


def test_links_left_over_by_stars(spark):
    docs = spark.createDataFrame(list(enumerate(_left_over(), 1)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, n=1, p=80, q=100).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


@pytest.mark.parametrize("sizes", [(600, 600), (1000, 1100), (2040, 2060), (5000, 4200), (513, 5000)])
def test_wide_bitmaps_bound_the_difference(sizes):
    rng = np.random.default_rng(sum(sizes))
    pool = rng.integers(0, 1 << 64, sum(sizes), dtype=np.uint64)
    for common in (0, min(sizes) // 2, min(sizes) * 9 // 10, min(sizes)):
        a, b = np.sort(pool[: sizes[0]]), np.sort(pool[sizes[0] - common : sizes[0] - common + sizes[1]])
        apart = sum(sizes) - 2 * common
        found = jaccard._differ(jaccard.wide_bitmap(a), jaccard.wide_bitmap(b))
        assert found <= apart and (found > 0 or not apart)
    assert jaccard.wide_bitmap(pool[:512]) is None


def test_large_unlinked_sets_do_not_meet(spark):
    """Pairs at a similarity of 0.6 end at the wide bitmaps; linked ones, and pairs with a small set, stay."""
    words, _ = _words(6000)
    texts = [words[:2000], words[500:2500], words[50:2050], words[:500], words[:520]]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    every = materialize(jaccard.features(docs, 1, "doc_id", "text"), "test-sets")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (3, 4)], "a long, b long")
    sizes = every.select(every.doc_id.alias("d"), every.n.alias("m"))
    for unique in (True, False):
        left = jaccard._narrowed(pairs, every, sizes, 80, 100, unique)
        assert sorted(map(tuple, left.collect())) == [(0, 2), (3, 4)]
    got = jaccard._verify(left, docs, sizes, 1, 80, 100, "doc_id", "text", True)
    assert sorted(map(tuple, got.collect())) == [(0, 2), (3, 4)]


def test_lasting_rows_are_not_copied(spark):
    prose = " ".join(f"river{k} stone" for k in range(40))
    rows = [(7, prose, 0), (7, prose, 1), (None, prose, 2), (3, prose + " end", 3), (8, None, 4), (None, "a b", 5), (9, "c d", 6), (9, "c d", 7)]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string, _c0 int").repartition(3), "test-docs")
    copies = lambda: len(glob.glob(scratch_root(spark).removeprefix("file://") + "/lexiforge/jaccard-rows-*"))
    before = copies()
    left = jaccard.deduplicate(docs, lasting=True)
    assert left.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in left.collect()), key=str) == sorted([(3, prose + " end"), (8, None), (None, "a b"), (9, "c d")], key=str)
    assert copies() == before
    twice = docs.crossJoin(spark.range(2).withColumnRenamed("id", "side"))  # rows share a place
    left = jaccard.deduplicate(twice, lasting=True)
    assert sorted(((r[0], r[1]) for r in left.collect()), key=str) == sorted([(3, prose + " end"), (8, None), (8, None), (None, "a b"), (9, "c d")], key=str)
    assert copies() == before + 1
