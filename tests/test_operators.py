import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrier.operators import quality as qa
from terrier.operators.aggregates import coarsen
from terrier.operators.dedup import dedup_latest
from terrier.operators.joins import left_enrich, merge_contexts, one_row_per_key
from terrier.operators.quantiles import ROW, aggregate_with_quantiles, exact_quantiles
from terrier.operators.sampling import hash_sample, random_sample, random_split
from terrier.operators.windows import calendar_lags, fill_series, lags, series


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- quantiles ------------------------------------------------------------------------

PROBS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p100": 1.0}


def hot_rows(n=6000, seed=3):
    """One key holds a third of the rows, one value half of that key."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(400)}")
        value = None if i % 41 == 0 else (7.5 if key == "hot" and i % 2 == 0 else
                                          round(rnd.lognormvariate(3, 3) * rnd.choice((1, 1, -1)), 2))
        rows.append((key, value))
    return rows


def test_quantiles_against_brute_force(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in PROBS.items():
            assert math.isclose(got[k][name], float(np.quantile(values, p)), rel_tol=1e-12, abs_tol=1e-9)


def test_dense_bands_are_cut_again(spark):
    """One band of one group with very many values, and tiny values of all magnitudes."""
    dense = spark.range(200_000).selectExpr("'dense' AS k", "1000D + id * 1e-5 AS v")
    tiny = spark.range(20_000).selectExpr("'tiny' AS k", "pow(10D, -3 - id / 70D) AS v")
    few = spark.range(40).selectExpr("CAST(NULL AS STRING) AS k", "CAST(id AS DOUBLE) AS v")
    df = dense.union(tiny).union(few).union(spark.sql("SELECT 'dense', CAST('Infinity' AS DOUBLE)"))
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, limit=100).collect()}
    plain = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, limit=None).collect()}
    assert got == plain and set(got) == {"dense", "tiny", None}
    want = np.quantile(1000 + np.arange(200_000) * 1e-5, 0.5, method="lower")
    assert abs(got["dense"].p50 - want) < 2e-5 and got["dense"].p100 == math.inf


def test_no_task_ranks_more_than_the_limit(spark):
    from terrier.operators import quantiles as qu

    df = spark.range(300_000).selectExpr("1000D + id * 1e-6 AS v")
    cells = df.selectExpr("struct('_' AS a) AS _g", "0L AS _before", "300000L AS _size", "v AS _v", "1L AS _n")
    hit = "(floor(0.5D * (_size - 1)) >= _start AND floor(0.5D * (_size - 1)) < _end)"
    kept = qu._refined(cells, hit, 500)
    assert 0 < kept.count() <= 500
    row = kept.agg(F.min("_before"), F.max("_v")).first()
    assert row[0] <= 149_999 < row[0] + kept.count()


def test_aggregate_with_quantiles_keeps_all_groups(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    parts = {"n": F.count(ROW), "s": F.sum("v")}
    got = {r.k: (r.n, r.s, r.m) for r in aggregate_with_quantiles(
        df, ["k"], parts, "v", {"m": 0.5}).collect()}
    assert got == {"a": (2, 4.0, 2.0), "b": (1, None, None), None: (1, 5.0, 5.0)}


def test_quantile_plan_ranks_only_within_bands(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    text = plan(exact_quantiles(df, ["k"], "v", {"m": 0.5}, limit=None))
    assert "percentile" not in text and "partial_count" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


# --- deduplication ----------------------------------------------------------------------

def test_dedup_hot_key(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("version"), F.col("id").alias("tie"))
    out = dedup_latest(df, ["k"], "version", ["tie"])
    rows = {r.k: (r.version, r.tie) for r in out.collect()}
    want = {}
    for i in range(n):
        k = 0 if i % 3 == 0 else i
        want[k] = max(want.get(k, (-1, -1)), (i % 7, i))
    assert rows == want
    text = plan(out)
    # the limit before the shuffle keeps one row per key and task
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_dedup_needs_ties(spark):
    with pytest.raises(ValueError):
        dedup_latest(spark.range(1), ["id"], "id", [])


# --- joins --------------------------------------------------------------------------------

@pytest.mark.parametrize("salts", [1, 8])
def test_left_enrich_keeps_rows(spark, salts):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, 10), (2, 20)], "k BIGINT, n BIGINT")
    out = left_enrich(left, right, ["k"], {"n": 0}, salts)
    assert out.count() == 900
    assert out.where("k = 1").count() == out.where("n = 10").count() == 301
    assert out.where("n = 0").count() == 900 - 301 - 1
    assert out.columns == ["k", "id", "n"]


def test_fan_out_is_refused(spark):
    twice = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k INT, d STRING, n INT")
    with pytest.raises(Exception, match="more than one row"):
        one_row_per_key(twice.select("k", "n"), ["k"]).collect()
    once = one_row_per_key(twice.where("d = 'a'").select("k", "n"), ["k"])
    assert [tuple(r) for r in once.collect()] == [(1, 1)]


def test_merge_contexts(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "k INT, a INT")
    b = spark.createDataFrame([(2, 3), (3, 4)], "k INT, b INT")
    got = {r.k: (r.a, r.b) for r in merge_contexts([a, b], ["k"]).collect()}
    assert got == {1: (1, None), 2: (2, 3), 3: (None, 4)}


# --- windows ---------------------------------------------------------------------------------

def test_row_lag_is_not_calendar_lag(spark):
    df = spark.createDataFrame(
        [("a", 2024, 1, 1.0), ("a", 2024, 3, 3.0), ("a", 2024, 4, 4.0)],
        "e STRING, annee INT, mois INT, x DOUBLE").withColumn("d", F.make_date("annee", "mois", F.lit(1)))
    w = series("e", "annee", "mois")
    out = df.withColumns({**lags("x", w, {1: "rows"}), **calendar_lags("x", "d", "e", {1: "months"})})
    got = [(r["rows"], r["months"]) for r in out.orderBy("mois").collect()]
    assert got == [(None, None), (1.0, None), (3.0, 3.0)]


def test_fill_order(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 1, None)], "e STRING, t INT, x DOUBLE")
    both = {(r.e, r.t): r.x for r in fill_series(df, "e", ["t"], ["x"]).collect()}
    assert both == {("a", 1): 5.0, ("a", 2): 5.0, ("a", 3): 5.0, ("b", 1): 0.0}
    ahead = {(r.e, r.t): r.x for r in fill_series(df, "e", ["t"], ["x"], True).collect()}
    assert ahead[("a", 1)] == 0.0


def test_one_sort_for_one_window(spark):
    from terrier.plans.features import rpt_features_commune_mois

    panel = spark.range(50).select(
        (F.col("id") % 2).alias("code_commune"), F.lit(2024).alias("annee"),
        (F.col("id") % 12).cast("int").alias("mois"), F.col("id").cast("double").alias("prix_m2_moy"))
    text = plan(rpt_features_commune_mois(panel))
    assert text.count("Sort [") == 1 and text.count("Exchange ") == 1


# --- aggregates, samples, checks ------------------------------------------------------------------

def test_coarsen(spark):
    df = spark.createDataFrame([(1, 10, 1.0), (1, 20, 2.0), (2, 5, 4.0)], "k INT, f INT, l DOUBLE")
    got = {r.k: (r.f, r.m, r.n) for r in coarsen(df, ["k"], ["f"], {"l": ("m", 1)}, "n").collect()}
    assert got == {1: (30, 1.5, 2), 2: (5, 4.0, 1)}


def test_samples(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    part = hash_sample(df, ["k"], 20)
    assert 800 < part.count() < 1200
    assert part.exceptAll(hash_sample(df.repartition(7), ["k"], 20)).count() == 0
    train, test = random_split(df, ["k"], 0.8)
    assert train.count() + test.count() == 20000 and train.join(test, "k").count() == 0
    assert 0.78 < train.count() / 20000 < 0.82
    sample = random_sample(df, ["k"], 500)
    assert sample.count() == 500
    assert sample.exceptAll(random_sample(df.repartition(5), ["k"], 500)).count() == 0
    assert random_sample(df.limit(10), ["k"], 500).count() == 10


def test_quality_report(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (2, "Z")], "k INT, l STRING")
    report = qa.quality_report([
        qa.not_null(df, "t", ["k", "l"]), qa.unique(df, "t", "k"),
        qa.accepted_values(df, "t", "l", ["A"]), qa.unique_grain(df, "t", ["k", "l"])])
    got = {(r["check"], r["column"]): r["failures"] for r in report.collect()}
    assert got == {("not_null", "k"): 0, ("not_null", "l"): 1, ("unique", "k"): 1,
                   ("accepted_values", "l"): 1, ("unique_grain", "k,l"): 0}


def test_checks_in_one_pass_equal_single_checks(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, None if i % 11 == 0 else "AZ"[i % 2], i, i // 2) for i in range(200)]
    rows += [(None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "k INT, l STRING, u INT, g INT")
    single = qa.quality_report([
        qa.not_null(df, "t", ["k", "l", "u"]), qa.accepted_values(df, "t", "l", ["A"]),
        qa.unique(df, "t", "k"), qa.unique(df, "t", "u"), qa.unique_grain(df, "t", ["k", "l"]),
        qa.unique_grain(df, "t", ["u", "g"])])
    once = qa.check_once(df, "t", ["k", "l", "u"], {"l": ["A"]}, ["k", "u"], [["k", "l"], ["u", "g"]])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, single.collect()))
    assert once.columns == qa.SHAPE
    df.where("u IS NOT NULL").write.parquet(f"{tmp_path}/t")
    clean = qa.check_once(spark.read.parquet(f"{tmp_path}/t"), "t", ["u"], None, ["u"], [["u", "g"]])
    assert "parquet" not in plan(clean).lower()             # without repeats the table is not read again
    assert sorted(r["failures"] for r in clean.collect()) == [0, 0, 0]
    empty = qa.check_once(df.limit(0), "t", ["k"], {"l": ["A"]}, ["u"], [["g"]])
    assert [r["failures"] for r in empty.collect()] == [0] * 4


def test_declared_checks_cover_the_tables():
    for rules in qa.DECLARED.values():
        assert rules["not_null"]


def test_quantiles_rank_nan_last(spark):
    from terrier.operators.quantiles import value_band

    rows = spark.createDataFrame([(x,) for x in (5.0, float("nan"), float("inf"), float("-inf"))], "v double")
    bands = [r[0] for r in rows.selectExpr(f"{value_band('v')} AS b").collect()]
    assert bands[3] < bands[0] < bands[2] < bands[1]
