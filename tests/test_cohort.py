from datetime import datetime

from pyspark.sql import functions as F

from casegraph.functions.scalars import hours_between, nan_to_null
from casegraph.operators import aggregates as ag
from casegraph.operators import cohort as co
from casegraph.operators.report import funnel, observed


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cohort_and_complement(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k bigint, v string")
    ids = spark.createDataFrame([(2,), (3,), (None,), (2,)], "k bigint")
    cohort = co.cohort_ids(ids, "k")
    assert rows(cohort) == [(2,), (3,)]
    assert rows(co.restrict(table, cohort, "k")) == [(2, "b"), (2, "c")]
    left = co.excluded(table, cohort, "k", "x")
    assert left.count() == 2 and {r["reason"] for r in left.collect()} == {"x"}
    assert rows(co.restrict_wide(table, cohort, "k", "v")) == [(2, "b"), (2, "c")]
    assert co.restrict_wide(table, cohort, "k", "v", "left_anti").count() == 2


def test_many_ids_of_notes_are_not_broadcast(spark):
    table = spark.range(40).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    ids = spark.range(20, 1000).toDF("k")
    for how, want in (("left_semi", set(range(20, 40))), ("left_anti", set(range(20)))):
        found = co.restrict_wide(table, ids, "k", "v", how, max_broadcast_ids=10)
        assert {r["k"] for r in found.collect()} == want and found.count() == 20
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        # ids that no note has are not multiplied
        (known,) = {f.rsplit("/", 1)[0] for f in found.inputFiles() if "known-ids" in f}
        assert spark.read.parquet(known).count() == 20


def test_empty_cohort_is_no_error(spark):
    table = spark.createDataFrame([(1, 2.0)], "k bigint, v double")
    none = co.cohort_ids(table.where("false"), "k")
    assert co.restrict(table, none, "k").count() == 0


def test_interval_needs_both_ends(spark):
    t = datetime(2020, 1, 1)
    df = spark.createDataFrame(
        [(1, t, t), (2, t, datetime(2019, 1, 1)), (3, t, None), (4, None, t)], "k int, a timestamp, b timestamp"
    )
    assert [r["k"] for r in co.valid_interval(df, "a", "b").collect()] == [1]


def test_missing_numbers_do_not_pass_thresholds(spark):
    df = spark.createDataFrame([(1, 17.0), (2, 18.0), (3, None), (4, float("nan"))], "k int, age double")
    clean = df.withColumn("age", nan_to_null(F.col("age")))
    assert [r["k"] for r in co.at_least(clean, "age", 18).collect()] == [2]


def test_plausible_range_is_inclusive(spark):
    values = [-1000.0, -1000.01, 1e6, 1e6 + 1, float("nan"), None]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    assert sorted(r["k"] for r in co.plausible(df, "v", -1000, 1e6).collect()) == [0, 2]


def test_first_row_does_not_depend_on_file_order(spark):
    data = [(1, "b", 2), (1, "a", 9), (1, "c", 1), (None, "x", 1), (None, "w", 5)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, v string, n int").repartition(3)
        assert rows(co.first_per_key(df, ["k"]).where("k = 1")) == [(1, "a", 9)]
        assert rows(co.first_per_key(df, ["k"], ["n"]).where("k = 1")) == [(1, "c", 1)]
        assert co.first_per_key(df, ["k"]).count() == 2
    assert co.first_per_key(df.select("k"), ["k"]).count() == 2


def test_hours_with_and_without_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-01-01 00:00:00' a, timestamp_ntz'2020-01-02 12:15:00' b")
    assert df.select(hours_between(F.col("a"), F.col("b"))).first()[0] == 36.25
    zoned = df.select(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    assert zoned.select(hours_between(F.col("a"), F.col("b"))).first()[0] == 36.25


def test_deviation_of_one_value_is_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0)], "k int, v double")
    got = {r["k"]: (r["mean_value"], r["std_value"]) for r in ag.profile_per_key(df, ["k"], "v").collect()}
    assert got[1] == (5.0, None) and abs(got[2][1] - 2**0.5) < 1e-12


def test_items_and_mean(spark):
    df = spark.createDataFrame([(1, 7, 1.0), (1, 7, 3.0), (1, 8, 5.0), (2, None, None)], "k int, i int, v double")
    got = {r["k"]: (r["n"], r["m"]) for r in ag.items_and_mean(df, "k", "i", "v", "n", "m").collect()}
    assert got == {1: (2, 3.0), 2: (0, None)}


def test_funnel_and_observation(spark):
    df = spark.range(100)
    report = funnel([("t", "half", df, df.where("id < 50")), ("t", "none", df, df.where("false"))])
    assert rows(report) == [("t", "half", 100, 50, 50), ("t", "none", 100, 0, 100)]
    counted, observation = observed(df, "scan")
    assert counted.where("id < 10").count() == 10
    assert observation.get["rows"] == 100


def test_hot_key(spark):
    """One key holds most rows; the results are those of a plain computation."""
    hot = spark.range(40_000).select(
        F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(F.col("id")).alias("k"), (F.col("id") % 50).alias("item"),
        F.col("id").cast("double").alias("v"),
    )
    data = hot.toPandas()
    counts = ag.distinct_per_key(hot, ["k"], "item").toPandas().set_index("k")["n"]
    assert counts.to_dict() == data.groupby("k")["item"].nunique().to_dict()
    first = co.first_per_key(hot, ["k"], ["v"]).toPandas().set_index("k")["v"]
    assert first.to_dict() == data.groupby("k")["v"].min().to_dict()


def test_distinct_sketches_are_near_and_add_up(spark):
    """Three standard errors of 1.6 %; two increments with common values count once; nulls do not count."""
    df = spark.range(60_000).selectExpr("id % 3 AS k", "CASE WHEN id % 7 > 0 THEN id % 20011 END AS v", "id < 40000 AS early")
    exact = {r.k: r.n for r in ag.distinct_per_key(df, ["k"], "v").collect()}
    approx = {r.k: r.n for r in ag.distinct_per_key(df, ["k"], "v", approx=True).collect()}
    parts = [ag.distinct_sketches(df.where(f"early = {flag}"), ["k"], "v") for flag in ("true", "false")]
    added = {r.k: r.n for r in ag.estimated_distinct(ag.merged_sketches(parts[0].union(parts[1]), ["k"]), ["k"]).collect()}
    for found in (approx, added):
        assert set(found) == set(exact) and all(abs(found[k] - n) <= 0.05 * n for k, n in exact.items())
    few = ag.distinct_per_key(spark.createDataFrame([(1, "a"), (1, None), (1, "a"), (2, None)], "k int, v string"), ["k"], "v", approx=True)
    assert {r.k: r.n for r in few.collect()} == {1: 1, 2: 0}
    assert ag.distinct_per_key(df.limit(0), ["k"], "v", approx=True).count() == 0
