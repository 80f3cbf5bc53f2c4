"""Series preparation, backtests, metrics and attribution."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from terrier.catalogue.analysis import panel_sparse
from terrier.catalogue.marts import SECTION, Warehouse, features_dense, features_wide
from terrier.catalogue.registry import query
from terrier.catalogue.roles import quantile, rnd
from terrier.catalogue.sql import BLOCKS, compose
from terrier.functions.numeric import settle
from terrier.operators import attribution as at
from terrier.operators import metrics as me
from terrier.operators import rows
from terrier.operators import series as se
from terrier.operators import trees as tr
from terrier.operators import vectors as ve
from terrier.plans import forecasting as fc
from terrier.session import cut_lineage

ENTITY = "code_commune"
DENSE_NUMBERS = [
    "nb_transactions", "pct_appt", "pct_maison", "surface_moy", "nb_pieces_moy",
    "prix_m2_lag_1m", "prix_m2_lag_3m", "prix_m2_lag_6m", "prix_m2_lag_12m",
    "prix_m2_roll3m", "prix_m2_roll6m", "prix_m2_roll12m", "evol_1m_pct", "evol_12m_pct",
    "mois_sin", "mois_cos",
]
SERIES = fc.SEQUENCE_FEATURES
TARGET = SERIES[0]
NAIVE = "prix_m2_lag_1m"
LABELS = {"surface_moy": "Surface moyenne", "prix_m2_lag_1m": "Prix du mois précédent"}
ALL_LABELS = {**at.FEATURE_LABELS, **LABELS}
FIRST = 1900  # the orders lie before 2000


def _loaded(spark, sf):
    return fc.load_features(features_dense(spark, sf), DENSE_NUMBERS)


_LOADED_SQL = (
    "SELECT code_commune, code_departement, annee, mois, prix_m2_med, "
    + ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in DENSE_NUMBERS)
    + " FROM features_dense WHERE prix_m2_med > 0 AND prix_m2_lag_12m IS NOT NULL"
)
EXTRA = {
    "loaded_dense": _LOADED_SQL,
    "series_wide": (
        "SELECT code_commune, annee, mois, " + ", ".join(f"{c}::DOUBLE AS {c}" for c in SERIES)
        + " FROM features_wide WHERE prix_m2_med > 0 AND prix_m2_lag_12m IS NOT NULL"
    ),
    "grid_wide": (
        "SELECT code_commune, year(d)::INTEGER AS annee, month(d)::INTEGER AS mois FROM ("
        "SELECT code_commune, unnest(generate_series(min(make_date(annee, mois, 1)), "
        "max(make_date(annee, mois, 1)), INTERVAL 1 MONTH)) AS d FROM series_wide GROUP BY 1)"
    ),
    "filled_wide": (
        "SELECT code_commune, annee, mois, annee * 100 + mois AS periode, "
        + ", ".join(
            f"coalesce(last_value({c} IGNORE NULLS) OVER w, "
            f"first_value({c} IGNORE NULLS) OVER v, 0)::DOUBLE AS {c}" for c in SERIES)
        + " FROM grid_wide LEFT JOIN series_wide USING (code_commune, annee, mois) "
        "WINDOW w AS (PARTITION BY code_commune ORDER BY annee, mois "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        "v AS (PARTITION BY code_commune ORDER BY annee, mois "
        "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    ),
    "years_wide": (
        "SELECT max(annee) AS test_year, max(annee) FILTER (annee < y) AS val_year FROM series_wide, "
        "(SELECT max(annee) AS y FROM series_wide)"
    ),
    "eligible_wide": (
        "SELECT code_commune, o.n AS nb_observes, g.n AS nb_grille, g.t AS nb_train FROM "
        "(SELECT code_commune, count(*) AS n FROM series_wide GROUP BY 1) o JOIN "
        "(SELECT code_commune, count(*) AS n, count(*) FILTER (annee < val_year) AS t "
        "FROM filled_wide, years_wide GROUP BY 1) g USING (code_commune) "
        "WHERE o.n >= 12 AND g.n >= 21 AND g.t >= 15"
    ),
    "kept_wide": "SELECT * FROM filled_wide WHERE code_commune IN (SELECT code_commune FROM eligible_wide)",
    "scaler_wide": (
        "SELECT code_commune, "
        + ", ".join(
            f"avg({c}) AS {c}_mean, CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop({c}) END "
            f"AS {c}_scale" for c in SERIES)
        + " FROM kept_wide, years_wide WHERE annee < val_year GROUP BY 1"
    ),
    "sequences_wide": (
        "SELECT * FROM (SELECT code_commune, periode, count(*) OVER b AS n_x, "
        "first_value(periode) OVER b AS x_first, "
        + ", ".join(f"sum({c}) OVER b AS x_{c}" for c in SERIES)
        + ", prix_m2_med AS y1, lead(prix_m2_med, 1) OVER w AS y2, lead(prix_m2_med, 2) OVER w AS y3, "
        "periode AS p1, lead(periode, 1) OVER w AS p2, lead(periode, 2) OVER w AS p3 FROM kept_wide "
        "WINDOW w AS (PARTITION BY code_commune ORDER BY periode), "
        "b AS (PARTITION BY code_commune ORDER BY periode ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)) "
        "WHERE n_x = 12 AND y3 IS NOT NULL"
    ),
    "split_wide": (
        "SELECT * FROM (SELECT s.*, CASE WHEN p3 // 100 < val_year THEN 'train' "
        "WHEN p1 // 100 = val_year AND p3 // 100 = val_year AND x_first // 100 >= val_year - 1 THEN 'val' "
        "WHEN p1 // 100 = test_year AND p3 // 100 = test_year AND x_first // 100 >= val_year THEN 'test' "
        "END AS split FROM sequences_wide s, years_wide) WHERE split IS NOT NULL"
    ),
}


def sql(text: str) -> str:
    return compose(text, EXTRA)


@query("M01_load_features", sql("SELECT * FROM loaded_dense"))
def load_features(spark, sf):
    return _loaded(spark, sf)


@query("M02_monthly_grid", sql(
    "SELECT *, annee * 100 + mois AS periode FROM grid_sparse"))
def monthly_grid(spark, sf):
    return se.monthly_grid(panel_sparse(spark, sf), ENTITY)


class Wide:
    """The wide series of one data folder with the years of its splits.

    The panel and the filled series are written once; what follows reads them.
    """

    def __init__(self, spark, sf):
        self.panel = cut_lineage(fc.load_series(features_wide(spark, sf)), "panel")
        self.train_last, self.val_year, self.test_year = se.last_years(self.panel)

    @property
    def grid(self):
        return se.grid_join(se.monthly_grid(self.panel, ENTITY), self.panel, ENTITY, SERIES)

    @cached_property
    def filled(self):
        return cut_lineage(ve.fill_monthly_vectors(self.panel, ENTITY, SERIES, after=FIRST), "series")

    @property
    def eligible(self):
        return se.eligible_entities(self.panel, self.filled, ENTITY, self.val_year)

    @property
    def kept(self):
        return self.filled.join(self.eligible.select(ENTITY), ENTITY, "left_semi")

    @property
    def stats(self):
        return ve.fit_vector_scaler(self.kept, ENTITY, F.col("annee") < self.val_year)

    @property
    def scaled(self):
        return ve.scale_vectors(self.kept, self.stats, ENTITY, len(SERIES))

    def split(self):
        named = self.kept.withColumn("_y", F.get(ve.VECTOR, F.lit(0)))
        made = se.build_sequences(named, ENTITY, ve.VECTOR, {"y": "_y"})
        return se.temporal_split(made, self.train_last, self.val_year, self.test_year)


def _settled(digits: int, prefix: str = ""):
    return [settle(c, digits).alias(prefix + c) for c in SERIES]


@query("J05_grid_join", sql(f"""
SELECT g.*, g.annee * 100 + g.mois AS periode, {', '.join(SERIES)} FROM grid_wide g
LEFT JOIN series_wide USING (code_commune, annee, mois)"""))
def grid_join(spark, sf):
    return Wide(spark, sf).grid


@query("M03_fill_monthly", sql("SELECT * FROM filled_wide"))
def fill_monthly(spark, sf):
    panel = fc.load_series(features_wide(spark, sf))
    # Read by the grid and by its join: written once.
    filled = ve.fill_monthly_vectors(cut_lineage(panel, "panel"), ENTITY, SERIES, after=FIRST)
    return ve.unpack(filled, SERIES)


_GAPS = ["prix", "nb", "prix_f"]


@query("M03_fill_monthly_gaps", sql(
    "SELECT code_commune, annee, mois, annee * 100 + mois AS periode, "
    + ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER w, "
        f"first_value({c} IGNORE NULLS) OVER v, 0)::DOUBLE AS {c}" for c in _GAPS)
    + " FROM grid_sparse LEFT JOIN panel_sparse USING (code_commune, annee, mois) "
    "WINDOW w AS (PARTITION BY code_commune ORDER BY annee, mois "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "v AS (PARTITION BY code_commune ORDER BY annee, mois "
    "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"))
def fill_gaps(spark, sf):
    """The panel by customer, where most months have no order."""
    panel = cut_lineage(panel_sparse(spark, sf), "panel")
    return ve.unpack(ve.fill_monthly_vectors(panel, ENTITY, _GAPS, after=FIRST), _GAPS)


@query("M04_eligible_entities", sql("SELECT * FROM eligible_wide"))
def eligible(spark, sf):
    return Wide(spark, sf).eligible


@query("M05_fit_scaler", sql("SELECT code_commune, " + ", ".join(
    f"{rnd(f'{c}_{p}', 4)} AS {c}_{p}" for c in SERIES for p in ("mean", "scale"))
    + " FROM scaler_wide"))
def fit_scaler(spark, sf):
    return Wide(spark, sf).stats.select(ENTITY, *[
        settle(F.get(p, F.lit(i)), 4).alias(f"{c}_{p}")
        for i, c in enumerate(SERIES) for p in ("mean", "scale")])


@query("M06_scale", sql("SELECT code_commune, annee, mois, " + ", ".join(
    f"{rnd(f'({c} - {c}_mean) / {c}_scale', 4)} AS {c}" for c in SERIES)
    + " FROM kept_wide JOIN scaler_wide USING (code_commune)"))
def scale(spark, sf):
    return ve.unpack(Wide(spark, sf).scaled, SERIES).select(ENTITY, "annee", "mois", *_settled(4))


@query("M06_unscale", sql(
    f"SELECT code_commune, annee, mois, {rnd('prix_m2_med', 2)} AS prix_m2_med FROM kept_wide"))
def unscale(spark, sf):
    w = Wide(spark, sf)
    scaled = w.scaled.select(ENTITY, "annee", "mois", F.get(ve.VECTOR, F.lit(0)).alias(TARGET))
    back = ve.unscale_value(scaled, w.stats, ENTITY, TARGET, 0)
    return back.withColumn(TARGET, settle(TARGET, 2))


@query("J06_stats_join_back", sql("SELECT code_commune, annee, mois, " + ", ".join(
    f"{rnd(f'{c} - {c}_mean', 2)} AS {c}" for c in SERIES)
    + " FROM kept_wide JOIN scaler_wide USING (code_commune)"))
def stats_join(spark, sf):
    w = Wide(spark, sf)
    joined = w.kept.join(w.stats, ENTITY)
    return joined.select(ENTITY, "annee", "mois", *[
        settle(F.get(ve.VECTOR, F.lit(i)) - F.get("mean", F.lit(i)), 2).alias(c)
        for i, c in enumerate(SERIES)])


@query("M07_temporal_split", sql(
    "SELECT code_commune, periode, split, x_first AS x_first_period, "
    + ", ".join(f"{rnd(f'x_{c}', 2)} AS x_{c}" for c in SERIES) + ", y1, y2, y3 FROM split_wide"))
def temporal_split(spark, sf):
    summed = Wide(spark, sf).split().withColumn("_x", ve.window_sums("x", len(SERIES)))
    return summed.select(
        ENTITY, "periode", "split", "x_first_period",
        *[settle(F.get("_x", F.lit(i)), 2).alias(f"x_{c}") for i, c in enumerate(SERIES)],
        *[F.element_at("y", i).alias(f"y{i}") for i in (1, 2, 3)])


@query("M08_sequence_targets", sql(" UNION ALL ".join(
    f"SELECT code_commune, periode AS periode_origine, {h} AS horizon, "
    f"(p{h} // 100)::INTEGER AS annee_pred, (p{h} % 100)::INTEGER AS mois_pred, "
    f"CASE WHEN y{h} > 0 THEN y{h} END AS reel FROM split_wide WHERE split = 'test'"
    for h in (1, 2, 3))))
def sequence_targets(spark, sf):
    test = Wide(spark, sf).split().where("split = 'test'")
    test = test.withColumnRenamed("periode", "periode_origine")
    targets = se.sequence_targets(test, [ENTITY, "periode_origine"], {"y": "reel"})
    return targets.withColumn("reel", se.positive_or_null("reel"))


@query("M09_walk_forward_folds", sql("""
SELECT * FROM (SELECT (row_number() OVER (ORDER BY annee) - 1)::INTEGER AS fold, annee AS annee_test,
  min(annee) OVER b AS annee_debut, (sum(n) OVER b)::BIGINT AS n_train, n AS n_test
  FROM (SELECT annee, count(*) AS n FROM loaded_dense GROUP BY 1)
  WINDOW b AS (ORDER BY annee ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE fold >= 2 AND n_train >= 200"""))
def folds(spark, sf):
    return fc.walk_forward_folds(_loaded(spark, sf))


# --- fits ---------------------------------------------------------------------------------

# A fit takes a minute or more even on small data: queries on one folder share it.
_FITTED: dict = {}


def _fitted(kind: str, spark, sf, make):
    key = kind, spark.sparkContext.applicationId, sf
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def _backtest(spark, sf):
    return _fitted("backtest", spark, sf, lambda: fc.backtest_gbt(
        _loaded(spark, sf), "essai", DENSE_NUMBERS))


@query("M10_backtest_gbt")
def backtest(spark, sf):
    return _backtest(spark, sf).predictions


@query("M10_backtest_gbt_metrics")
def backtest_metrics(spark, sf):
    return _backtest(spark, sf).metrics.drop("run_date")


def _horizons(spark, sf):
    def make():
        panel = cut_lineage(fc.load_series(features_wide(spark, sf)), "panel")
        sequences, stats = fc.prepare_sequences(panel, SERIES, TARGET, after=FIRST)
        return fc.forecast_multi_horizon(sequences, stats, "essai")

    return _fitted("horizons", spark, sf, make)


@query("M11_forecast_multi_horizon")
def multi_horizon(spark, sf):
    return _horizons(spark, sf)[0]


@query("M11_horizon_metrics")
def multi_horizon_metrics(spark, sf):
    return _horizons(spark, sf)[1].drop("run_date")


def _last_model(spark, sf):
    """The loaded rows, written once, and the model of the last fold."""
    def make():
        df = cut_lineage(_loaded(spark, sf), "loaded")
        done = fc.backtest_gbt(df, "essai", DENSE_NUMBERS, last_only=True)
        return df, list(done.models.values())[-1]

    return _fitted("last", spark, sf, make)


@query("M18_feature_importance")
def importance(spark, sf):
    return fc.feature_importance(_last_model(spark, sf)[1], DENSE_NUMBERS, 20)


@query("M19_permutation_importance")
def permutation(spark, sf):
    df, model = _last_model(spark, sf)
    return fc.permutation_importance(df, model, DENSE_NUMBERS, [ENTITY, "annee", "mois"])


TREE_FEATURES = [fc.CATEGORY, *DENSE_NUMBERS]


def _tree_contributions(spark, sf):
    df, model = _last_model(spark, sf)
    kept = [ENTITY, fc.CATEGORY, "annee", "mois", *DENSE_NUMBERS]
    return fc.tree_contributions(df, model, DENSE_NUMBERS, kept)


@query("M19_attribute_trees")
def attribute_trees(spark, sf):
    return _tree_contributions(spark, sf).drop(*DENSE_NUMBERS)


@query("M20_tree_ranking")
def tree_ranking(spark, sf):
    written = cut_lineage(_tree_contributions(spark, sf), "contributions")
    return at.attribution_ranking(written, TREE_FEATURES, ALL_LABELS)


@query("M21_tree_impact_by_group")
def tree_impact(spark, sf):
    return at.attribution_by_group(_tree_contributions(spark, sf), "surface_moy", fc.CATEGORY)


@query("M22_explain_entity_trees")
def explain_trees(spark, sf):
    ids = ["annee", "mois", tr.BASE, tr.PREDICTION]
    return at.explain_entity(
        _tree_contributions(spark, sf), ENTITY, "1", ids, TREE_FEATURES, values=True)


# A small forest as it stands, so that SQL can walk it: feature, threshold, share, means.
DECLARED_TREES = [
    {"weight": 1.0, "root": 1000.0, "feature": "prix_m2_lag_1m", "threshold": 1500.0, "means": (900.0, 1300.0),
     "then": ("surface_moy", 25.0, (850.0, 960.0), (1250.0, 1340.0))},
    {"weight": 0.5, "root": 10.0, "feature": "surface_moy", "threshold": 24.0, "means": (-20.0, 35.0),
     "then": ("mois_sin", 0.0, (-30.0, -5.0), (20.0, 60.0))},
    {"weight": 0.25, "root": -4.0, "feature": "evol_12m_pct", "threshold": 5.0, "means": (-12.0, 16.0),
     "then": ("prix_m2_lag_1m", 1450.0, (-15.0, -8.0), (12.0, 22.0))},
]
DECLARED_FEATURES = ["prix_m2_lag_1m", "surface_moy", "mois_sin", "evol_12m_pct"]


def _declared_forest():
    place = {c: i for i, c in enumerate(DECLARED_FEATURES)}
    nodes = []
    for t, tree in enumerate(DECLARED_TREES):
        then, at_, *ends = tree["then"]
        split = lambda i, v, f, cut, left: dict(
            tree=t, id=i, value=v, left=left, right=left + 1, feature=place[f], threshold=cut, categories=(), of=None)
        nodes += [split(0, tree["root"], tree["feature"], tree["threshold"], 1),
                  split(1, tree["means"][0], then, at_, 3), split(2, tree["means"][1], then, at_, 5)]
        nodes += [dict(tree=t, id=3 + 2 * i + k, value=end[k], left=-1, right=-1, feature=0, threshold=0.0,
                       categories=(), of=None) for i, end in enumerate(ends) for k in (0, 1)]
    return tr.Forest.of(nodes, [tree["weight"] for tree in DECLARED_TREES])


def _declared_sql(feature: str) -> str:
    terms = ["0::DOUBLE"]
    for tree in DECLARED_TREES:
        first = f"{tree['feature']} <= {tree['threshold']}"
        then, at_, low, high = tree["then"]
        left, right = tree["means"]
        if tree["feature"] == feature:
            terms.append(f"{tree['weight']} * (CASE WHEN {first} THEN {left} ELSE {right} END - {tree['root']})")
        if then == feature:
            second = f"{then} <= {at_}"
            terms.append(
                f"{tree['weight']} * CASE WHEN {first} THEN CASE WHEN {second} THEN {low[0]} ELSE {low[1]} END - {left} "
                f"ELSE CASE WHEN {second} THEN {high[0]} ELSE {high[1]} END - {right} END")
    return " + ".join(f"({t})" for t in terms)


_BASE = sum(t["weight"] * t["root"] for t in DECLARED_TREES)


@query("M19_attribute_declared_trees", sql(
    "SELECT *, " + rnd("base + " + " + ".join(f"contrib_{c}" for c in DECLARED_FEATURES), 4)
    + f" AS prediction FROM (SELECT code_commune, annee, mois, {_BASE}::DOUBLE AS base, "
    + ", ".join(f"{rnd(_declared_sql(c), 4)} AS contrib_{c}" for c in DECLARED_FEATURES)
    + " FROM loaded_dense)"))
def attribute_declared(spark, sf):
    features = {c: F.col(c) for c in DECLARED_FEATURES}
    out = tr.forest_contributions(
        _loaded(spark, sf), _declared_forest(), features, [ENTITY, "annee", "mois"])
    return out.withColumns({c: settle(c, 4) for c in out.columns if c[:8] == at.PREFIX or c == tr.PREDICTION})


# --- metrics, on the naive forecast (last month's mean) ----------------------------------------

def _naive(spark, sf):
    return _loaded(spark, sf).withColumn("prix_m2_pred", F.col(NAIVE))


_Y, _P = "prix_m2_med", "prix_m2_lag_1m"
_MAE = f"avg(abs({_P} - {_Y}))"
_RMSE = f"sqrt(avg(power({_P} - {_Y}, 2)))"
_MAPE = f"coalesce(avg(CASE WHEN {_Y} > 0 THEN abs(({_P} - {_Y}) / {_Y}) END) * 100, 0)"


@query("M12_predictions_frame", sql(f"""
SELECT 'essai' AS run_id, code_commune, annee AS annee_pred, mois AS mois_pred,
  {_P}::FLOAT AS prix_m2_pred, {_Y}::FLOAT AS prix_m2_reel FROM loaded_dense"""))
def predictions(spark, sf):
    return fc.predictions_frame(_naive(spark, sf), "essai")


@query("M13_error_metrics", sql(f"""
SELECT annee, count(*) AS n_samples, {rnd(_MAE, 4)} AS mae, {rnd(_RMSE, 4)} AS rmse,
  {rnd(_MAPE, 4)} AS mape, count(DISTINCT code_commune) AS n_communes
FROM loaded_dense GROUP BY 1"""))
def error_metrics(spark, sf):
    return me.error_metrics(_naive(spark, sf), "prix_m2_med", "prix_m2_pred", ["annee"], ENTITY)


@query("M14_r2", sql(f"""
SELECT {rnd(f'1 - sum(power({_P} - {_Y}, 2)) / (count(*) * var_pop({_Y}))', 4)} AS r2
FROM loaded_dense"""))
def r2(spark, sf):
    return _naive(spark, sf).agg(me.r2("prix_m2_med", "prix_m2_pred").alias("r2"))


@query("M15_metrics_by_group", sql(f"""
SELECT code_departement, {rnd(_MAE, 2)} AS mae, count(*) AS n,
  {quantile(_Y, 0.5, 2)} AS prix_reel_med FROM loaded_dense GROUP BY 1"""))
def by_group(spark, sf):
    naive = _naive(spark, sf).select("code_departement", "prix_m2_med", "prix_m2_pred")
    return me.metrics_by_group(
        cut_lineage(naive, "naive"), "prix_m2_med", "prix_m2_pred", "code_departement")


@query("M16_mean_over_folds", sql(f"""
SELECT {rnd('avg(mae)', 1)} AS mae, {rnd('avg(rmse)', 1)} AS rmse, {rnd('avg(mape)', 1)} AS mape
FROM (SELECT annee, {rnd(_MAE, 4)} AS mae, {rnd(_RMSE, 4)} AS rmse, {rnd(_MAPE, 4)} AS mape
  FROM loaded_dense GROUP BY 1)"""))
def over_folds(spark, sf):
    return me.mean_over_folds(error_metrics(spark, sf))


@query("M17_error_histogram", sql(f"""
WITH e AS (SELECT abs({_P} - {_Y}) AS raw, least(abs({_P} - {_Y}), 1000) AS e FROM loaded_dense),
s AS (SELECT min(e) AS lo, (max(e) - min(e)) / 60::DOUBLE AS width,
  {quantile('raw', 0.5, 2)} AS mediane FROM e)
SELECT bin, count(*) AS n, {rnd('any_value(lo) + bin * any_value(width)', 4)} AS borne,
  any_value(mediane) AS mediane
FROM (SELECT least(floor((e - lo) / width), 59)::INTEGER AS bin, lo, width, mediane FROM e, s)
GROUP BY bin""").replace("\nWITH e AS", ",\ne AS", 1))
def histogram(spark, sf):
    naive = _naive(spark, sf).select("prix_m2_med", "prix_m2_pred")
    return me.error_histogram(cut_lineage(naive, "naive"), "prix_m2_med", "prix_m2_pred")


# --- attribution: a linear model with two features, exact ---------------------------------------

LINEAR = ["surface_moy", "prix_m2_lag_1m"]

EXTRA["linear"] = (
    "SELECT m1, m2, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS w1, "
    "(c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS w2 FROM ("
    "SELECT avg(surface_moy) AS m1, avg(prix_m2_lag_1m) AS m2, var_pop(surface_moy) AS v1, "
    "var_pop(prix_m2_lag_1m) AS v2, covar_pop(surface_moy, prix_m2_lag_1m) AS v12, "
    "covar_pop(surface_moy, prix_m2_med) AS c1, covar_pop(prix_m2_lag_1m, prix_m2_med) AS c2 "
    "FROM loaded_dense)"
)
EXTRA["contributions"] = (
    "SELECT code_commune, code_departement, annee, mois, w1 * (surface_moy - m1) AS contrib_surface_moy, "
    "w2 * (prix_m2_lag_1m - m2) AS contrib_prix_m2_lag_1m FROM loaded_dense, linear"
)


def _contributions(spark, sf):
    df = cut_lineage(
        _loaded(spark, sf).select(ENTITY, "code_departement", "annee", "mois", *LINEAR, "prix_m2_med"),
        "linear")
    vectors = VectorAssembler(inputCols=LINEAR, outputCol="features").transform(df)
    model = LinearRegression(
        labelCol="prix_m2_med", solver="normal", regParam=0.0).fit(vectors)
    means = df.agg(*[F.avg(c).alias(c) for c in LINEAR]).first().asDict()
    weights = dict(zip(LINEAR, [float(w) for w in model.coefficients]))
    return at.linear_contributions(df, weights, means)


@query("M19_attribute_linear", sql(f"""
SELECT code_commune, annee, mois, {rnd('contrib_surface_moy', 2)} AS contrib_surface_moy,
  {rnd('contrib_prix_m2_lag_1m', 2)} AS contrib_prix_m2_lag_1m FROM contributions"""))
def attribute(spark, sf):
    return _contributions(spark, sf).select(ENTITY, "annee", "mois", *[
        settle(f"contrib_{c}", 2).alias(f"contrib_{c}") for c in LINEAR])


# The summaries run on all features of the panel, with declared weights.
WEIGHTS = {
    "nb_transactions": 1.5, "pct_appt": -0.4, "pct_maison": 0.3, "surface_moy": -2.5,
    "nb_pieces_moy": 6.0, "prix_m2_lag_1m": 0.35, "prix_m2_lag_3m": 0.2, "prix_m2_lag_6m": 0.1,
    "prix_m2_lag_12m": 0.15, "prix_m2_roll3m": 0.25, "prix_m2_roll6m": 0.12,
    "prix_m2_roll12m": 0.08, "evol_1m_pct": -1.2, "evol_12m_pct": 0.7, "mois_sin": 9.0,
    "mois_cos": -4.0,
}

EXTRA["contributions_all"] = (
    "SELECT code_commune, code_departement, annee, mois, "
    + ", ".join(f"{w}::DOUBLE * ({c} - avg({c}) OVER ()) AS contrib_{c}" for c, w in WEIGHTS.items())
    + " FROM loaded_dense"
)


def _all_contributions(spark, sf):
    df = cut_lineage(_loaded(spark, sf), "linear")
    means = df.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first().asDict()
    return at.linear_contributions(df, WEIGHTS, means)


@query("M19_attribute_linear_all", sql("SELECT code_commune, annee, mois, " + ", ".join(
    f"{rnd(f'contrib_{c}', 2)} AS contrib_{c}" for c in WEIGHTS) + " FROM contributions_all"))
def attribute_all(spark, sf):
    return _all_contributions(spark, sf).select(ENTITY, "annee", "mois", *[
        settle(f"contrib_{c}", 2).alias(f"contrib_{c}") for c in WEIGHTS])


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_RANKING = (
    "SELECT (row_number() OVER (ORDER BY importance DESC, feature))::INTEGER AS rang, feature, "
    "label, importance, " + rnd("100::DOUBLE * importance / sum(importance) OVER ()", 1)
    + " AS part_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_text(ALL_LABELS.get(c, c))} AS label, "
        f"{rnd(f'avg(abs(contrib_{c}))', 2)} AS importance FROM contributions_all" for c in WEIGHTS)
    + ")"
)


@query("M20_attribution_ranking", sql(_RANKING))
def ranking(spark, sf):
    return at.attribution_ranking(_all_contributions(spark, sf), list(WEIGHTS), ALL_LABELS)


@query("O03_top_k_features", sql(f"SELECT * FROM ({_RANKING}) WHERE rang <= 10"))
def top_features(spark, sf):
    return at.top_features(ranking(spark, sf), 10)


@query("M21_attribution_by_group", sql(
    f"SELECT code_departement, {rnd('avg(contrib_surface_moy)', 2)} AS impact "
    "FROM contributions_all GROUP BY 1"))
def impact_by_group(spark, sf):
    return at.attribution_by_group(_all_contributions(spark, sf), "surface_moy", "code_departement")


EXTRA["base_all"] = (
    "SELECT " + " + ".join(f"{w}::DOUBLE * avg({c})" for c, w in WEIGHTS.items()) + " AS base FROM loaded_dense")


@query("M22_explain_entity", sql(" UNION ALL ".join(
    f"SELECT annee, mois, {rnd('base', 2)} AS base, '{c}' AS feature, {rnd(c, 2)} AS valeur, "
    f"{rnd(f'contrib_{c}', 2)} AS contribution FROM contributions_all "
    f"JOIN loaded_dense USING (code_commune, code_departement, annee, mois), base_all WHERE code_commune = '1'"
    for c in WEIGHTS)))
def explain(spark, sf):
    """Value, contribution and mean prediction beside each other for one entity."""
    df = cut_lineage(_loaded(spark, sf), "linear")
    means = df.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first().asDict()
    base = sum(w * means[c] for c, w in WEIGHTS.items())
    parts = at.linear_contributions(df, WEIGHTS, means).withColumn("base", settle(F.lit(base), 2))
    rows_ = at.explain_entity(
        parts, ENTITY, "1", ["annee", "mois", "base"], list(WEIGHTS), values=True)
    return rows_.withColumns({
        "valeur": settle(F.col("valeur").cast("double"), 2), "contribution": settle("contribution", 2)})


@query("M23_exclude_columns", sql(
    "SELECT * EXCLUDE (code_commune, annee_min, annee_max, prix_m2_moy, prix_m2_q25, prix_m2_q75, "
    "prix_m2_med) FROM rpt_shap_commune"))
def exclude(spark, sf):
    w = Warehouse(spark, sf, landed=True)
    from terrier.plans.features import rpt_shap_commune

    section = rpt_shap_commune(w.sold(*SECTION), w.communes, w.ecln_year)
    kept = rows.exclude_columns(section, [
        "code_commune", "annee_min", "annee_max", "prix_m2_moy", "prix_m2_q25", "prix_m2_q75",
        "prix_m2_med"])
    return section.select(*kept)


assert set(EXTRA).isdisjoint(BLOCKS)
