"""The learner of boosted trees against Spark ML's, and how many jobs it needs."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrier.operators import boosting as bo
from terrier.plans import forecasting as fc
from terrier.session import use_checkpoints


def rows(spark, n=3000, parts=1):
    """Ties, zeros, a constant, a copied feature and skewed categories beside plain numbers."""
    r = np.random.default_rng(7)
    a, b, c = r.normal(size=(3, n))
    data = zip((r.integers(0, 30, n) ** 2 // 60).tolist(), a.tolist(), np.round(b).tolist(), (c * (r.random(n) < 0.3)).tolist(), (a * a + 2 * np.round(b) + c).tolist())
    df = spark.createDataFrame(list(data), "code_departement INT, a DOUBLE, b DOUBLE, c DOUBLE, prix_m2_med DOUBLE")
    df = df.withColumns({"code_departement": F.col("code_departement").cast("string"), "d": F.lit(0.0), "e": F.col("a")})
    df = df.repartition(parts, "a").persist()
    return fc.inputs_pipeline(["a", "b", "c", "d", "e"]).fit(df).transform(df)


def nodes(spark, model, folder):
    path = f"{folder}/{uuid.uuid4().hex}"
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").select("treeID", "nodeData.*").collect()


def alike(spark, left, right, folder):
    left, right = nodes(spark, left, folder), nodes(spark, right, folder)
    form = lambda r: (r.treeID, r.id, r.rawCount, r.leftChild, r.rightChild, r.split)
    assert [form(r) for r in left] == [form(r) for r in right]
    assert np.allclose([r.prediction for r in left], [r.prediction for r in right], rtol=1e-9, atol=1e-9)
    assert np.allclose([r.gain for r in left], [r.gain for r in right], rtol=1e-6, atol=1e-9)
    return left == right


def test_the_trees_are_those_of_spark_ml(spark, tmp_path):
    df = rows(spark)
    for params, trees, bins in ((fc.TreeParams(step=0.3), 8, 32), (fc.TreeParams(depth=3, min_leaf=1, row_share=0.5, feature_share=0.5), 5, 20)):
        learner = params.regressor(trees, "prix_m2_med", bins)
        got, want = learner.fit(df), learner.plain.fit(df)
        assert alike(spark, got, want, tmp_path)          # one block: every digit
        assert got.treeWeights == want.treeWeights and got.getMaxIter() == want.getMaxIter() == trees
        assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())


def test_thresholds_of_sampled_rows_and_several_blocks(spark, tmp_path):
    df = rows(spark, 24_000, 3)
    learner = fc.TreeParams().regressor(3, "prix_m2_med")
    alike(spark, learner.fit(df), learner.plain.fit(df), tmp_path)


def test_spread_blocks_grow_the_same_trees(spark, tmp_path, monkeypatch):
    use_checkpoints(spark)
    df = rows(spark, 2000, 5)
    learner = fc.TreeParams(depth=3, step=0.3).regressor(12, "prix_m2_med")
    here = learner.fit(df)
    monkeypatch.setattr(bo, "SMALL", 100)
    alike(spark, learner.fit(df), here, tmp_path)


def test_more_trees_need_no_more_jobs(spark):
    df, tracker = rows(spark), spark.sparkContext.statusTracker()
    found = []
    for trees in (2, 30):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "")
        fc.TreeParams(depth=4).regressor(trees, "prix_m2_med").fit(df)
        found.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0] == found[1] < 30


def test_rows_that_cannot_be_fitted(spark):
    df, learner = rows(spark, 100), fc.TreeParams().regressor(1, "prix_m2_med")
    with pytest.raises(ValueError):
        learner.fit(df.where("a > 1000"))
    with pytest.raises(Exception, match="finite"):
        learner.fit(df.withColumn("prix_m2_med", F.lit(float("nan"))))


def test_lanes_are_one_stream():
    def one_by_one(seed, n):
        state, out = bo.xorshift_start(seed), []
        for _ in range(n):
            parts = []
            for bits in (26, 27):
                state = (state ^ state << 21) & (1 << 64) - 1
                state ^= state >> 35
                state = (state ^ state << 4) & (1 << 64) - 1
                parts.append(state & (1 << bits) - 1)
            out.append((parts[0] << 27 | parts[1]) * 2.0 ** -53)
        return out

    for seed, n in ((42, 1), (43, 1000), (-5, 700)):
        assert bo.uniforms(seed, n).tolist() == one_by_one(seed, n)


def test_a_longer_fit_goes_on_from_a_shorter_one(spark, tmp_path, monkeypatch):
    use_checkpoints(spark)
    counted, counts = [], bo.grow_tree
    monkeypatch.setattr(bo, "grow_tree", lambda shape, tree, *a: counted.append(tree) or counts(shape, tree, *a))
    df, params = rows(spark, 2000, 4), fc.TreeParams(depth=3, step=0.3)
    for small in (bo.SMALL, 100):
        monkeypatch.setattr(bo, "SMALL", small)
        short = params.regressor(4, "prix_m2_med").fit(df)
        counted.clear()
        long = params.regressor(9, "prix_m2_med").fit(df, short)
        assert counted == ([4, 5, 6, 7, 8] if small == 100 else [])   # else in a task
        assert alike(spark, long, params.regressor(9, "prix_m2_med").fit(df), tmp_path)
