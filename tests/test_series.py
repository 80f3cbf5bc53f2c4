import threading

import numpy as np
from pyspark.sql import functions as F

from terrier.operators import attribution as at
from terrier.operators import metrics as me
from terrier.operators import series as se
from terrier.operators import trees as tr
from terrier.operators import vectors as ve
from terrier.plans import forecasting as fc


def panel(spark, months=40, entities=("a", "b"), gap=5):
    rows = []
    for e in entities:
        for i in range(months):
            if i % gap == gap - 1:
                continue
            rows.append((e, 2020 + i // 12, 1 + i % 12, 100.0 + i + (50 if e == "b" else 0), 1.0))
    return spark.createDataFrame(rows, "code_commune STRING, annee INT, mois INT, x DOUBLE, c DOUBLE")


def test_grid_is_complete(spark):
    grid = se.monthly_grid(panel(spark, 39), "code_commune")
    assert grid.count() == 2 * 39
    assert grid.where("mois NOT BETWEEN 1 AND 12").count() == 0


def test_corrupt_periods_are_dropped(spark):
    bad = spark.createDataFrame([("z", 1900, 1, 1.0, 1.0), ("z", 2020, 13, 1.0, 1.0)], panel(spark).schema)
    assert se.fill_monthly(bad, "code_commune", ["x"]).count() == 0


def test_sequence_count(spark):
    filled = se.fill_monthly(panel(spark, 39), "code_commune", ["x", "c"])
    made = se.build_sequences(filled, "code_commune", ["x", "c"], {"y": "x"})
    assert made.count() == 2 * (39 - 12 - 3 + 1)
    row = made.where("code_commune = 'a'").orderBy("periode").first()
    assert len(row.x) == 12 and all(len(r) == 2 for r in row.x) and len(row.y) == 3
    assert row.x_first_period == 202001 and list(row.y_periods) == [202101, 202102, 202103]
    assert row.y_last_period == 202103


def test_vector_scaler(spark):
    df = ve.pack(panel(spark, 20), ["x", "c"])
    stats = ve.fit_vector_scaler(df, "code_commune", F.col("annee") == 2020)
    xs = [r.v[0] for r in df.where("code_commune = 'a' AND annee = 2020").collect()]
    row = stats.where("code_commune = 'a'").first()
    assert np.isclose(row["mean"][0], np.mean(xs)) and np.isclose(row.scale[0], np.std(xs))
    assert row.scale[1] == 1.0 and row["mean"][1] == 1.0
    scaled = ve.unpack(ve.scale_vectors(df, stats, "code_commune", 2), ["x", "c"])
    assert scaled.where("c <> 0").count() == 0
    back = ve.unscale_value(scaled, stats, "code_commune", "x", 0)
    diff = back.join(ve.unpack(df, ["x0", "c0"]), ["code_commune", "annee", "mois"])
    assert diff.count() == df.count() and diff.where(F.abs(F.col("x") - F.col("x0")) > 1e-9).count() == 0


def test_one_training_row_gives_scale_one(spark):
    df = spark.createDataFrame([("a", 2020, [3.0, 4.0]), ("a", 2021, [9.0, 9.0])], "e STRING, annee INT, v ARRAY<DOUBLE>")
    row = ve.fit_vector_scaler(df, "e", F.col("annee") == 2020).first()
    assert list(row["mean"]) == [3.0, 4.0] and list(row.scale) == [1.0, 1.0]


def test_wide_series_equal_single_columns(spark):
    """Filled arrays, one window for all features, against the columns filled one by one."""
    names = [f"f{i}" for i in range(24)]
    df = panel(spark, 30).select("code_commune", "annee", "mois", *[
        F.when((F.col("mois") + F.lit(i)) % 4 > 0, F.col("x") * F.lit(float(i))).alias(c) for i, c in enumerate(names)])
    filled = ve.fill_monthly_vectors(df, "code_commune", names)
    wide = ve.unpack(filled, names)
    for c in (names[0], names[7], names[23]):
        one = se.fill_monthly(df.select("code_commune", "annee", "mois", c), "code_commune", [c])
        assert wide.select("code_commune", "periode", c).exceptAll(one.select("code_commune", "periode", c)).count() == 0
    assert wide.count() == 2 * 29  # the last month is a gap of the panel
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1


def test_window_sums(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 5.0]],)], "x ARRAY<ARRAY<DOUBLE>>")
    assert list(df.select(ve.window_sums("x", 2).alias("s")).first().s) == [4.0, 7.0]


def test_splits_are_disjoint_and_inside_their_years(spark):
    df = panel(spark, 48, gap=100)
    sequences, _ = fc.prepare_sequences(df, ["x", "c"], "x")
    rows = sequences.select("split", "periode", "y_last_period", "x_first_period").collect()
    spans = {"train": (2020, 2021), "val": (2022, 2022), "test": (2023, 2023)}
    assert {r.split for r in rows} == set(spans)
    for r in rows:
        low, high = spans[r.split]
        assert low <= r.periode // 100 and r.y_last_period // 100 <= high
        if r.split != "train":
            assert r.x_first_period // 100 >= low - 1
    assert sum(r.split == "test" for r in rows) == 2 * 10


def test_short_series_are_left_out(spark):
    df = panel(spark, 48, ("a",), 100).unionByName(panel(spark, 14, ("short",), 100))
    sequences, stats = fc.prepare_sequences(df, ["x", "c"], "x")
    assert [r.code_commune for r in stats.collect()] == ["a"]
    assert sequences.where("code_commune = 'short'").count() == 0


def test_folds(spark):
    df = spark.createDataFrame([(y,) for y in range(2020, 2025) for _ in range(150)], "annee INT")
    got = [(r.fold, r.annee_test, r.n_train, r.n_test) for r in fc.walk_forward_folds(df).collect()]
    assert got == [(2, 2022, 300, 150), (3, 2023, 450, 150), (4, 2024, 600, 150)]
    assert fc.walk_forward_folds(df, 500).count() == 1


def test_metrics(spark):
    rows = [(100.0, 110.0), (0.0, 5.0), (200.0, 190.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "y DOUBLE, p DOUBLE").withColumn("g", F.lit(1))
    row = me.error_metrics(df, "y", "p", ["g"]).first()
    assert row.n_samples == 3 and np.isclose(row.mae, 25 / 3, atol=1e-4)
    assert np.isclose(row.rmse, np.sqrt(225 / 3), atol=1e-4) and np.isclose(row.mape, 7.5)
    none = df.where("y = 0")
    assert me.error_metrics(none, "y", "p").first().mape == 0.0
    y, p = np.array([100, 0, 200.0]), np.array([110, 5, 190.0])
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert np.isclose(df.agg(me.r2("y", "p").alias("r")).first().r, want, atol=1e-4)


def test_histogram_counts_every_row(spark):
    rows = [(0.0, float(i * 7 % 1500)) for i in range(500)]
    df = spark.createDataFrame(rows, "y DOUBLE, p DOUBLE")
    got = {r.bin: r.n for r in me.error_histogram(df, "y", "p", 60, 1000.0).collect()}
    errors = np.clip([abs(p) for _, p in rows], 0, 1000)
    want, _ = np.histogram(errors, 60)
    assert got == {i: int(n) for i, n in enumerate(want) if n}


def test_contributions_add_up(spark):
    df = panel(spark, 20).withColumn("z", F.col("mois").cast("double"))
    means = df.agg(F.avg("x").alias("x"), F.avg("z").alias("z")).first().asDict()
    out = at.linear_contributions(df, {"x": 2.0, "z": -1.0}, means)
    total = at.contribution_sum(["x", "z"])
    pred = F.lit(2.0) * F.col("x") - F.col("z") - (2 * means["x"] - means["z"])
    assert out.where(F.abs(total - pred) > 1e-9).count() == 0
    ranking = at.attribution_ranking(out, ["x", "z"], {"x": "Iks"}).collect()
    assert [r.rang for r in ranking] == [1, 2] and abs(sum(r.part_pct for r in ranking) - 100) < 0.2
    assert {r.feature: r.label for r in ranking} == {"x": "Iks", "z": "z"}


def test_permutation_keeps_all_values(spark):
    df = spark.range(1000).select("id", (F.col("id") * 3).alias("f"))
    out = at.permuted(df, ["id"], "f", 4)
    assert out.count() == 1000 and out.select("f").exceptAll(df.select("f")).count() == 0
    assert out.where(F.col("f") != F.col("id") * 3).count() > 950
    again = at.permuted(df.repartition(7), ["id"], "f", 4)
    assert out.exceptAll(again.select(*out.columns)).count() == 0


def test_backtest_never_trains_on_the_test_year(spark):
    rows = [(str(i % 7), str(i % 3), 2020 + i // 200, 1 + i % 12, 100.0 + i % 50, float(i % 50))
            for i in range(800)]
    df = spark.createDataFrame(
        rows, "code_commune STRING, code_departement STRING, annee INT, mois INT, "
              "prix_m2_med DOUBLE, f DOUBLE")
    done = fc.backtest_gbt(df, "r", ["f"], fc.TreeParams(trees=6, first=3, patience=2, depth=3, step=0.5, min_leaf=1))
    assert sorted(done.models) == [2022, 2023]
    assert done.predictions.count() == 400
    got = {r.annee_test: (r.n_samples, r.n_communes) for r in done.metrics.collect()}
    assert got == {2022: (200, 7), 2023: (200, 7)}
    assert fc.feature_importance(done.models[2023], ["f"]).first().feature == "f"


def test_one_noisy_tree_ends_no_fit():
    errors = [10, 9, 9.5, 9.4, 8, 7, 7.2, 7.1, 6.9, *[7.5] * 4]
    assert fc.chosen_count(errors, 3) == (9, True)
    assert fc.chosen_count(errors, 10) == (9, False)   # more trees are needed to be sure
    assert fc.chosen_count([5.0], 50) == (1, False)
    assert fc.chosen_count([5.0, 6.0, 7.0], 2) == (1, True)
    assert fc.chosen_count([10, 11, 12, 1], 2) == (1, True)


def boosted_rows(spark, n=600):
    rows = [(i % 7, 1990 + i % 3, float(i % 50), float(i * 13 % 40), float((i % 50) ** 2 + 30 * (i * 13 % 40) + (i % 7) * 100))
            for i in range(n)]
    return spark.createDataFrame(rows, "g INT, annee INT, a DOUBLE, b DOUBLE, prix_m2_med DOUBLE").withColumns({
        "code_departement": F.col("g").cast("string"), "code_commune": F.concat(F.lit("c"), F.monotonically_increasing_id())})


def test_the_next_fit_is_as_long_as_its_best_count_needs():
    p = fc.TreeParams(trees=1500, patience=50)
    assert fc.longer(96, 96, False, p) == (192, False)       # still falling
    assert fc.longer(192, 147, False, p) == (247, True)      # likely to be confirmed
    assert fc.longer(247, 210, True, p) == (494, False)      # it was not: double again
    assert fc.longer(40, 10, False, p) == (80, True)         # never more than double
    assert fc.longer(1400, 1360, False, p) == (1460, True) and fc.longer(1460, 1450, True, p) == (1500, False)


def test_a_count_that_is_confirmed_is_fitted_once(spark, monkeypatch):
    df = fc.inputs_pipeline(["a", "b"]).fit(boosted_rows(spark)).transform(boosted_rows(spark))
    grown, regressor, best = [], fc.TreeParams.regressor, {}
    monkeypatch.setattr(fc.TreeParams, "regressor", lambda p, trees, *a: grown.append(trees) or regressor(p, trees, *a))
    monkeypatch.setattr(
        fc.GBTRegressionModel, "evaluateEachIteration",
        lambda m, rows, loss: [float(abs(i + 1 - best[m.getNumTrees])) for i in range(m.getNumTrees)])
    params = fc.TreeParams(trees=64, first=4, patience=4, depth=2, min_leaf=1)
    best.update({4: 4, 8: 6, 14: 6})
    fit = fc.fit_boosted(df.where("annee < 1992"), df.where("annee = 1992"), "prix_m2_med", params)
    assert sorted(grown) == [4, 6, 8, 14] and fit.trees == fit.model.getNumTrees == 6
    grown.clear()
    best.update({14: 12, 28: 12})                             # a later best: what was begun does not count
    fit = fc.fit_boosted(df.where("annee < 1992"), df.where("annee = 1992"), "prix_m2_med", params)
    assert sorted(grown) == [4, 6, 8, 12, 14, 28] and fit.trees == fit.model.getNumTrees == 12


def test_the_second_fit_goes_on_beside_the_first(spark, monkeypatch):
    df = fc.inputs_pipeline(["a", "b"]).fit(boosted_rows(spark)).transform(boosted_rows(spark))
    both, first, regressor = threading.Barrier(2), {4, 8}, fc.TreeParams.regressor

    def meet(p, trees, *a):
        if trees in first:
            first.remove(trees)
            both.wait(60)                                     # a fit that waits for the other never gets there
        return regressor(p, trees, *a)

    monkeypatch.setattr(fc.TreeParams, "regressor", meet)
    params = fc.TreeParams(trees=8, first=4, patience=8, depth=2, min_leaf=1)
    train, held = df.where("annee < 1992"), df.where("annee = 1992")
    done = fc.fit_boosted(train, held, "prix_m2_med", params, ahead=True)
    monkeypatch.setattr(fc.TreeParams, "regressor", regressor)
    alone = params.regressor(8, "prix_m2_med").fit(train.coalesce(1))
    assert done.errors == list(alone.evaluateEachIteration(held, "absolute"))


def test_a_fit_that_is_not_needed_is_called_off(spark, monkeypatch):
    df = fc.inputs_pipeline(["a", "b"]).fit(boosted_rows(spark)).transform(boosted_rows(spark))
    ended, regressor, off = [], fc.TreeParams.regressor, fc.call_off
    monkeypatch.setattr(fc.GBTRegressionModel, "evaluateEachIteration", lambda m, rows, loss: [1.0, 2.0, 3.0, 4.0])
    monkeypatch.setattr(fc.TreeParams, "regressor", lambda p, trees, *a: regressor(p, 1500 if trees == 8 else trees, *a))
    monkeypatch.setattr(fc, "call_off", lambda s, begun: ended.append(begun[0]) or off(s, begun))
    params = fc.TreeParams(trees=8, first=4, patience=2, depth=2, min_leaf=1)
    done = fc.fit_boosted(df.where("annee < 1992"), df.where("annee = 1992"), "prix_m2_med", params, ahead=True)
    assert done.trees == done.model.getNumTrees == 1
    assert [f.done() and (f.cancelled() or f.exception() is not None) for f in ended] == [True]
    assert df.count() == 600                                  # nothing else is cancelled


def test_the_first_trees_are_a_fit_of_that_many(spark):
    rows = boosted_rows(spark).withColumn("unused", F.lit(1.0))
    inputs = fc.inputs_pipeline(["a", "b", "unused"]).fit(rows)
    df = inputs.transform(rows).coalesce(1)
    params = fc.TreeParams(depth=3, step=0.3, min_leaf=2)
    long, alone = (params.regressor(n, "prix_m2_med").fit(df) for n in (7, 4))
    cut = fc.first_trees(spark, long, 4)
    assert (cut.getNumTrees, cut.getMaxIter(), long.getNumTrees) == (4, 4, 7) and cut.treeWeights == alone.treeWeights
    got, want = (m.transform(df).select("code_commune", "prediction").collect() for m in (cut, alone))
    assert {r[0]: round(r[1], 9) for r in got} == {r[0]: round(r[1], 9) for r in want}
    trees = fc.forest(cut)
    assert len(trees.roots) == 4 and np.isclose(trees.base, fc.forest(alone).base)
    ranks = [fc.feature_importance(fc.PipelineModel([m]), ["a", "b", "unused"]).collect() for m in (cut, alone)]
    assert [r.feature for r in ranks[0]] == [r.feature for r in ranks[1]] and len(ranks[0]) == 4
    assert np.allclose([r.importance for r in ranks[0]], [r.importance for r in ranks[1]])


def test_the_final_fit_goes_on_beside_the_one_that_chooses(spark, monkeypatch):
    df = fc.inputs_pipeline(["a", "b"]).fit(boosted_rows(spark)).transform(boosted_rows(spark))
    train, held = df.where("annee < 1992"), df.where("annee = 1992")
    grown, regressor, best = [], fc.TreeParams.regressor, {}
    monkeypatch.setattr(fc.TreeParams, "regressor", lambda p, trees, *a: grown.append(trees) or regressor(p, trees, *a))
    monkeypatch.setattr(
        fc.GBTRegressionModel, "evaluateEachIteration",
        lambda m, rows, loss: [float(abs(i + 1 - best[m.getNumTrees])) for i in range(m.getNumTrees)])
    for most, bests, count, want in (
            (64, {4: 4, 8: 3}, 3, [4, 4, 8]),                          # no third fit after the second
            (8, {4: 4, 8: 6}, 6, [4, 8, 8]),                           # the longest fit settles on any count
            (64, {4: 4, 8: 6, 14: 9}, 9, [4, 4, 6, 8, 9, 14]),         # a later best: a final fit of its own
            (64, {4: 4, 8: 6, 14: 12, 28: 12}, 12, [4, 4, 6, 8, 14, 24, 28])):   # the next double has both again
        params = fc.TreeParams(trees=most, first=4, patience=4, depth=2, min_leaf=1)
        grown.clear(), best.clear(), best.update(bests)
        done = fc.fit_boosted(train, held, "prix_m2_med", params, ahead=True)
        assert sorted(grown) == want and done.trees == done.model.getNumTrees == count
        alone = regressor(params, count, "prix_m2_med").fit(train.unionByName(held).coalesce(1))
        got, same = ({r[0]: r[1] for r in m.transform(df).select("code_commune", "prediction").collect()} for m in (done.model, alone))
        assert len(got) == 600 and all(np.isclose(got[k], same[k]) for k in same)


def test_small_data_is_fitted_by_some_tasks():
    p = fc.TreeParams()
    assert [fc.fit_tasks(n, p) for n in (0, 600, 24_999, 25_000, 47_953, 59_939)] == [1, 1, 1, 2, 3, 4]
    assert [fc.fit_tasks(n, p) for n in (200_000, 200_001, 3_600_000)] == [4, 5, 72]   # as before


def test_staged_fit_chooses_and_refits(spark):
    df = fc.inputs_pipeline(["a", "b"]).fit(boosted_rows(spark)).transform(boosted_rows(spark))
    params = fc.TreeParams(trees=40, first=4, patience=3, depth=3, step=0.3, min_leaf=2)
    train, held = df.where("annee < 1992"), df.where("annee = 1992")
    done = fc.fit_boosted(train, held, "prix_m2_med", params)
    assert done.trees == fc.chosen_count(done.errors, 3)[0] and len(done.errors) > 4
    assert done.model.getNumTrees == done.trees
    # The staged errors are those of the growing sums of trees.
    fitted = params.regressor(len(done.errors), "prix_m2_med").fit(train.coalesce(1))
    row = fitted.transform(held).agg(F.avg(F.abs(F.col("prediction") - F.col("prix_m2_med")))).first()[0]
    assert np.isclose(row, done.errors[-1])
    # The chosen model has seen the held-out rows: their error is lower than when they were held out.
    after = done.model.transform(held).agg(F.avg(F.abs(F.col("prediction") - F.col("prix_m2_med")))).first()[0]
    assert after < done.errors[done.trees - 1]


def test_without_held_out_rows_the_first_trees_stay(spark):
    df = fc.inputs_pipeline(["a", "b"]).fit(boosted_rows(spark)).transform(boosted_rows(spark))
    params = fc.TreeParams(trees=40, first=3, depth=2, min_leaf=2)
    assert fc.fit_boosted(df, df.where("annee > 2000"), "prix_m2_med", params).trees == 3


def walked(nodes, weights, x):
    """Contributions of one row, node by node."""
    by = {(n["tree"], n["id"]): n for n in nodes}
    out, base = [0.0] * len(x), 0.0
    for t, w in enumerate(weights):
        n = by[t, 0]
        base += w * n["value"]
        while n["left"] >= 0:
            v = x[n["feature"]]
            left = v in n["categories"] if n["of"] is not None else v <= n["threshold"]
            c = by[t, n["left"] if left else n["right"]]
            out[n["feature"]] += w * (c["value"] - n["value"])
            n = c
    return out, base


def node(tree, id, value, left=-1, right=-1, feature=0, threshold=0.0, categories=(), of=None):
    return dict(tree=tree, id=id, value=value, left=left, right=right, feature=feature, threshold=threshold, categories=categories, of=of)


def test_contributions_against_brute_force():
    nodes = [node(0, 0, 10.0, 1, 2, 0, 5.0), node(0, 1, 7.0, 3, 4, 1, None, (0.0, 2.0), 3), node(0, 2, 14.0),
             node(0, 3, 6.0), node(0, 4, 9.0), node(1, 0, 1.0, 1, 2, 1, None, (1.0,), 3), node(1, 1, -1.0), node(1, 2, 2.0), node(2, 0, 3.0)]
    weights = [1.0, 0.5, 0.25]
    trees = tr.Forest.of(nodes, weights)
    x = np.array([[a, b] for a in (4.0, 5.0, 6.0, np.nan) for b in (0.0, 1.0, 2.0, 3.0)])
    got = trees.contributions(x, cells=7)
    for row, parts in zip(x, got):
        want, base = walked(nodes, weights, row)
        assert np.allclose(parts, want) and np.isclose(trees.base, base)


def test_tree_contributions_add_up_to_the_prediction(spark):
    df = boosted_rows(spark)
    inputs = fc.inputs_pipeline(["a", "b"]).fit(df)
    params = fc.TreeParams(trees=12, first=12, patience=50, depth=4, step=0.3, min_leaf=2)
    done = fc.fit_boosted(inputs.transform(df), None, "prix_m2_med", params)
    model = fc.PipelineModel([*inputs.stages, done.model])
    got = fc.tree_contributions(df, model, ["a", "b"], ["code_commune", "annee", "prix_m2_med"])
    want = model.transform(df).select("code_commune", F.col("prediction").alias("p"))
    both = got.join(want, "code_commune")
    off = F.abs(F.col("prediction") - F.col("p")) + F.abs(F.col("base") + F.col("contrib_code_departement") + F.col("contrib_a") + F.col("contrib_b") - F.col("p"))
    assert both.count() == 600 and both.where(off > 1e-6).count() == 0
    ranking = at.attribution_ranking(got, ["code_departement", "a", "b"])
    assert ranking.first().feature == "a"
    one = at.explain_entity(got.join(df.select("code_commune", "a", "b"), "code_commune"), "code_commune", "c0", ["base"], ["a", "b"], values=True)
    assert [(r.feature, float(r.valeur)) for r in one.collect()] == [("a", 0.0), ("b", 0.0)]


def test_permutation_needs_one_exchange(spark):
    df = boosted_rows(spark)
    inputs = fc.inputs_pipeline(["a", "b"]).fit(df)
    params = fc.TreeParams(trees=8, first=8, depth=4, step=0.3, min_leaf=2)
    model = fc.PipelineModel([*inputs.stages, fc.fit_boosted(inputs.transform(df), None, "prix_m2_med", params).model])
    out = fc.permutation_importance(df, model, ["a", "b"], ["code_commune"], 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") <= 2
    got = {r.feature: r.importance for r in out.collect()}
    assert set(got) == {"code_departement", "a", "b"} and got["a"] > got["b"] > 0
