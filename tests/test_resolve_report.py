from lexiforge.operators import resolve


def test_unresolved_targets(spark):
    rows = [(i, "b", f"e{i % 7}") for i in range(20)] + [(30, "A", None), (31, "A", "x"), (32, "a", "y"), (33, "a", "y"), (34, None, None)]
    lost = spark.createDataFrame([(o, t, e, 0) for o, t, e in rows], "ord long, target string, example string, n int")
    got = [(r["target"], r["n"], r["examples"]) for r in resolve.unresolved_targets(lost).collect()]
    assert got == [("b", 20, ["e0", "e1", "e2", "e3", "e4"]), ("A", 2, ["x"]), ("a", 2, ["y"]), (None, 1, [])]
    assert resolve.unresolved_targets(lost.limit(0)).count() == 0
