"""Packing in parallel and the splittable marker scan against sequential restatements."""

import random

import pytest

from lexiforge.operators import pack
from lexiforge.sources import markers


def greedy(sizes, limit):
    bank, used, out = 0, 0, []
    for n in sizes:
        if not bank or used + 1 + n >= limit:
            bank, used = bank + 1, 3 + n
        else:
            used += 1 + n
        out.append(bank)
    return out


@pytest.mark.parametrize(("limit", "top", "n"), [(40, 36, 900), (1000, 9, 2000), (50, 5, 40), (12, 0, 300), (100_000, 50, 500)])
def test_like_one_stream(spark, monkeypatch, limit, top, n):
    monkeypatch.setattr(pack, "LIMITS", 2)
    monkeypatch.setattr(pack, "FAN", 3)
    r = random.Random(limit)
    sizes = [r.randint(0, top) for _ in range(n)]
    orders = sorted(r.sample(range(10 * n), n))
    df = spark.createDataFrame(list(zip(orders, sizes, strict=True)), "ord long, size int").repartition(5)
    got = [x["bank"] for x in pack.pack(df, "ord", "size", limit).orderBy("ord").collect()]
    assert got == greedy(sizes, limit)


def test_composed_runs_are_the_whole_run():
    import numpy as np

    r = random.Random(8)
    for _ in range(300):
        limit = r.randint(5, 60)
        sizes = np.array([r.randint(0, limit - 4) for _ in range(r.randint(2, 40))])
        k = r.randint(1, len(sizes) - 1)
        whole, both = pack.Run.of_rows(sizes, limit), pack.Run.of_rows(sizes[:k], limit).then(pack.Run.of_rows(sizes[k:], limit), limit)
        for used in range(3, limit):
            assert [x.tolist() for x in whole.after(np.array([used]), limit)] == [x.tolist() for x in both.after(np.array([used]), limit)]


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "ord long, size int")
    assert [x["bank"] for x in pack.pack(df, "ord", "size", 10).orderBy("ord").collect()] == [1, 1]
    assert pack.pack(df.filter("false"), "ord", "size", 10).count() == 0
    with pytest.raises(Exception, match="exceeds the component limit"):
        pack.pack(df, "ord", "size", 8).collect()


def test_numbers_across_splits(spark, tmp_path):
    r = random.Random(1)
    lines = ["" if r.random() < 0.2 else f"[Roman] {'é' * r.randint(0, 40)} {i}" for i in range(5000)]
    (tmp_path / "one.txt").write_text("\r\n".join(lines), newline="")
    parts = tmp_path / "parts"
    parts.mkdir()
    for k in range(5):
        (parts / f"part-{k}").write_text("\n".join(lines[k * 1000 : k * 1000 + 1000]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        for path in ("one.txt", "parts"):
            found = markers.numbered_lines(spark, str(tmp_path / path))
            assert spark.read.text(str(tmp_path / path)).rdd.getNumPartitions() > 5
            assert sorted(map(tuple, found.filter("line <> ''").collect())) == [(i, x) for i, x in enumerate(lines, 1) if x]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
