"""Skew-safe carry-forward equals the window definition, including a key that spans many
partitions and values that block inheritance ('')."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapfeed.operators.sequence import carry_forward


def _window(df):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("want", F.last("v", ignorenulls=True).over(w))


def test_carry_forward_matches_window_with_hot_key(spark):
    # key 1 holds most rows and spans every range partition; sparse values, some blocking ''.
    rows = []
    for i in range(3000):
        k = 1 if i % 10 else (i % 7) + 2
        v = None if i % 13 else ("" if i % 39 == 0 else f"v{i}")
        rows.append((i, k, i // 3, v))
    df = spark.createDataFrame(rows, "id long, k long, t long, v string")
    got = carry_forward(df, "k", ["t", "id"], "v", "got", num_partitions=12)
    cmp = _window(df).join(got.select("id", "got"), "id")
    bad = cmp.where(~F.col("want").eqNullSafe(F.col("got")))
    assert got.count() == 3000
    assert bad.count() == 0


def test_carry_forward_leading_nulls_stay_null(spark):
    df = spark.createDataFrame([(1, 1, 1, None), (2, 1, 2, "a"), (3, 2, 1, None), (4, 2, 2, None)],
                               "id long, k long, t long, v string")
    got = {r["id"]: r["got"] for r in carry_forward(df, "k", ["t", "id"], "v", "got", num_partitions=3).collect()}
    assert got == {1: None, 2: "a", 3: None, 4: None}


def test_carry_forward_types_and_null_keys(spark):
    """Null keys form one group; bigints, doubles and timestamps keep their values."""
    big = 9007199254740993
    rows = [(i, None if i % 2 else 1, i, big + i if i % 5 == 0 else None, i / 3 if i % 7 == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, k long, t long, v long, d double").withColumn("at", F.when(F.col("v").isNotNull(), F.timestamp_millis("t")))
    for value in ("v", "d", "at"):
        w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        want = {r["id"]: r["w"] for r in df.withColumn("w", F.last(value, ignorenulls=True).over(w)).collect()}
        got = {r["id"]: r["got"] for r in carry_forward(df, "k", ["t", "id"], value, "got", num_partitions=7).collect()}
        assert got == want


def test_carry_forward_has_one_native_plan(spark):
    df = spark.createDataFrame([(1, 1, 1, "a")], "id long, k long, t long, v string")
    plan = carry_forward(df, "k", ["t", "id"], "v", "got")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_number_rows_and_concat(spark):
    """Numbers and joined texts of a hot key come from several ranges."""
    import random

    from pyspark.sql import functions as F

    from snapfeed.operators.sequence import number_rows, ordered_concat
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "b", "c", None]), i, rng.choice([None, f"v{i}", "x"])) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, v string")
    expected, texts = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        n, parts = texts.setdefault(k, [0, []])
        expected[k, o] = n
        texts[k][0] += 1
        if v is not None:
            parts.append(v)
    found = number_rows(df, "k", ["o"], "n", num_partitions=7)
    assert {(r["k"], r["o"]): r["n"] for r in found.collect()} == expected
    got = ordered_concat(df, "k", ["o"], "v", "|", "t", num_partitions=7)
    assert {r["k"]: (r["n"], r["t"]) for r in got.collect()} == {k: (n, "|".join(p) if p else None) for k, (n, p) in texts.items()}
    none = ordered_concat(df.withColumn("v", F.lit(None).cast("string")), "k", ["o"], "v", "|", "t")
    assert {r["t"] for r in none.collect()} == {None}
    assert number_rows(df.limit(0), "k", ["o"], "n").count() == 0
