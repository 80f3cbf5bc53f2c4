"""Feature loading, walk-forward backtests and multi-horizon forecasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrier.operators.attribution import DONOR, with_donors
from terrier.operators.boosting import BoostedTrees
from terrier.operators.metrics import error_metrics, mae, rmse
from terrier.operators.rows import drop_null, union_pages
from terrier.operators.series import (
    HORIZON, LOOKBACK, build_sequences, eligible_entities, last_years, positive_or_null,
    sequence_targets, temporal_split,
)
from terrier.operators.trees import forest, forest_contributions
from terrier.operators.vectors import (
    VECTOR, fill_monthly_vectors, fit_vector_scaler, scale_vectors, unscale_value,
)
from terrier.session import cut_lineage, use_checkpoints
from terrier.sources.sinks import params_json

TARGET = "prix_m2_med"
ENTITY = "code_commune"
CATEGORY = "code_departement"

# Model features, in the order of the sequences.
NUMERIC_FEATURES = [
    "nb_transactions", "pct_appt", "pct_maison", "surface_moy", "nb_pieces_moy",
    "pct_passoires_thermiques", "conso_ep_moy", "nb_commences", "taux_concretisation",
    "nb_entrees_ls", "prix_m2_neuf_moy", "delai_ecoulement_moy",
    "prix_m2_lag_1m", "prix_m2_lag_3m", "prix_m2_lag_6m", "prix_m2_lag_12m",
    "prix_m2_roll3m", "prix_m2_roll6m", "prix_m2_roll12m",
    "evol_1m_pct", "evol_12m_pct", "mois_sin", "mois_cos",
]
SEQUENCE_FEATURES = [TARGET, *NUMERIC_FEATURES]
MIN_TRAIN_ROWS = 200
FEATURES, CODE = "features", "_cat"
# Small data is fitted in up to SPREAD tasks of SPREAD_ROWS rows or more, on any cluster: Spark
# draws the rows of a tree by partition, so their number must not follow the cores.
SPREAD, SPREAD_ROWS = 4, 12_500


def load_features(
    features: DataFrame, numeric: list[str] = NUMERIC_FEATURES, ids: list[str] = (ENTITY, CATEGORY)
) -> DataFrame:
    """Rows with a target and a year of history; missing numbers become 0."""
    known = features.where((F.col(TARGET) > 0) & F.col("prix_m2_lag_12m").isNotNull())
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric]
    return known.select(*ids, "annee", "mois", TARGET, *numbers)


def load_series(
    features: DataFrame, columns: list[str] = SEQUENCE_FEATURES, ids: list[str] = (ENTITY,)
) -> DataFrame:
    """The same rows for sequences: missing numbers stay NULL, for the fill to take from other months."""
    known = features.where((F.col(TARGET) > 0) & F.col("prix_m2_lag_12m").isNotNull())
    return known.select(*ids, "annee", "mois", *[F.col(c).cast("double").alias(c) for c in columns])


def walk_forward_folds(df: DataFrame, minimum: int = MIN_TRAIN_ROWS) -> DataFrame:
    """One row per fold: test year, rows before it, rows in it.

    The first two years only train; folds with too little history are left out.
    """
    years = df.groupBy("annee").agg(F.count(F.lit(1)).alias("n_test"))
    w = Window.partitionBy().orderBy("annee")  # one row per year
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return (
        years.withColumns({
            "fold": F.row_number().over(w) - 1, "n_train": F.sum("n_test").over(before),
            "annee_debut": F.min("annee").over(before),
        })
        .where((F.col("fold") >= 2) & (F.col("n_train") >= minimum))
        .select("fold", F.col("annee").alias("annee_test"), "annee_debut", "n_train", "n_test")
    )


@dataclass(frozen=True)
class TreeParams:
    """Gradient-boosted trees.

    ``trees`` is the most a model may have. How many it gets is settled on held-out rows:
    the count with the least mean absolute error, once ``patience`` further trees have not
    lowered it. ``first`` trees are grown at first, then more (``longer``).
    ``feature_share`` is the share of features that every split may look at.
    ``rows_per_task`` keeps small data in few tasks.
    """

    trees: int = 1500
    patience: int = 50
    first: int = 96
    depth: int = 6
    step: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_leaf: int = 20
    rows_per_task: int = 50_000
    seed: int = 42

    def regressor(self, trees: int, label: str, bins: int = 32) -> BoostedTrees:
        return BoostedTrees(GBTRegressor(
            labelCol=label, featuresCol=FEATURES, lossType="squared", maxIter=trees,
            maxDepth=self.depth, stepSize=self.step, subsamplingRate=self.row_share,
            featureSubsetStrategy=str(self.feature_share), maxBins=bins,
            minInstancesPerNode=self.min_leaf, seed=self.seed,
        ))


def chosen_count(errors: list[float], patience: int) -> tuple[int, bool]:
    """Tree count with the least error, and whether ``patience`` more trees confirmed it.

    ``errors`` has one value per tree count, from one tree on. One tree, or a few, that
    raise the error end nothing.
    """
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def longer(trees: int, best: int, short: bool, params: TreeParams) -> tuple[int, bool]:
    """Trees of the next fit after an unsettled one, and whether it is a short step.

    Twice as many; but where half the patience has passed since the best count, just what
    confirms it with room for a somewhat later one. Of two steps in a row one doubles, so
    that many near misses do not add up to many fits.
    """
    if not short and 2 * (trees - best) >= params.patience:
        return min(2 * trees, best + 2 * params.patience, params.trees), True
    return min(2 * trees, params.trees), False


@dataclass
class Fit:
    """A model on all rows, with the errors on the held-out rows that chose its size."""

    model: GBTRegressionModel
    trees: int
    errors: list[float]


def first_trees(spark: SparkSession, model: GBTRegressionModel, count: int) -> GBTRegressionModel:
    """The model as it was when it had ``count`` trees: boosting adds trees and changes none.

    It does not know the number of features, so its importances end with the last one used.
    """
    if count == model.getNumTrees:
        return model
    jvm = spark._jvm
    trees = JavaWrapper._new_java_array(
        list(model._java_obj.trees())[:count], jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    weights = JavaWrapper._new_java_array(list(model.treeWeights)[:count], jvm.double)
    made = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights))
    return model._copyValues(made, {model.maxIter: count})


def fit_tasks(rows: int, params: TreeParams) -> int:
    """Tasks of a fit: a level of a tree is one job, and its time is that of its largest task."""
    return max(-(-rows // params.rows_per_task), min(SPREAD, rows // SPREAD_ROWS), 1)


def beside(pool: ThreadPoolExecutor, spark: SparkSession, fit: Callable, *args) -> tuple[Future, str]:
    """``fit(*args)`` in a thread of ``pool``, with a tag of its own on its jobs."""
    tag = f"fit-{uuid.uuid4().hex}"

    def run():
        spark.sparkContext.addJobTag(tag)
        return fit(*args)

    return pool.submit(inheritable_thread_target(spark)(run)), tag


def call_off(spark: SparkSession, begun: tuple[Future, str]) -> None:
    """End what ``beside`` began. A fit is a row of jobs, so the next one may need it too."""
    future, tag = begun
    while not future.cancel() and not future.done():
        spark.sparkContext.cancelJobsWithTag(tag)
        wait([future], 0.1)


def fit_boosted(
    train: DataFrame, held: DataFrame | None, label: str, params: TreeParams, bins: int = 32,
    ahead: bool = False,
) -> Fit:
    """Choose the number of trees on ``held``, then fit that many on ``train`` and ``held``.

    The errors of all tree counts come from one pass over the held-out rows: their
    predictions are summed up tree by tree. A fit that is too short goes on with more
    trees (``longer``). Where it is likely to confirm a count, the final fit of that many
    trees goes on beside it, and is called off and made again if another count is chosen.
    Without held-out rows the model gets ``first`` trees. With ``ahead``, if the rows leave
    half of the cores idle, the second fit goes on beside the first. Beside it, and beside
    every doubled fit, all rows are fitted with as many trees as it can settle on; once it
    has, the model is the first trees of that fit. They are called off if the first fit
    settles the count; leave it out where other fits go on already.
    """
    def ready(df: DataFrame) -> tuple[DataFrame, int]:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        return df, df.count()

    spark = train.sparkSession
    train, n = ready(train)
    more = 0

    def fitted(trees: int, df: DataFrame, rows: int, shorter: GBTRegressionModel | None = None) -> GBTRegressionModel:
        tasks = fit_tasks(rows, params)
        laid = df.coalesce(tasks) if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)
        return params.regressor(trees, label, bins).fit(laid, shorter)

    model = None

    def grow(trees: int) -> GBTRegressionModel:
        return fitted(trees, train, n, model)

    def final(trees: int) -> GBTRegressionModel:
        return fitted(trees, train.unionByName(held) if more else train, n + more)

    def both(trees: int) -> tuple[GBTRegressionModel, GBTRegressionModel | None]:
        most = trees if trees >= params.trees else trees - params.patience
        if most < 1:
            return grow(trees), None
        with ThreadPoolExecutor(1) as other:
            whole = other.submit(inheritable_thread_target(spark)(final), most)
            return grow(trees), whole.result()

    begun, finals, whole = {}, {}, None
    try:
        count, errors = min(params.first, params.trees), []
        if held is not None:
            held, more = ready(held)
        with ThreadPoolExecutor(2) as pool:
            try:
                trees, short = count, False
                twice = min(2 * trees, params.trees)
                idle = ahead and 2 * fit_tasks(n, params) <= spark.sparkContext.defaultParallelism
                if idle and more and twice > trees:
                    begun[twice] = beside(pool, spark, both, twice)
                while more:
                    model, whole = begun.pop(trees)[0].result() if trees in begun else (grow(trees), None)
                    errors = list(model.evaluateEachIteration(held, "absolute"))
                    count, settled = chosen_count(errors, params.patience)
                    if settled or trees >= params.trees:
                        break
                    trees, short = longer(trees, count, short, params)
                    if begun:  # half done: sooner there than a new one
                        trees, short = max(begun), False
                    elif idle and not short:
                        begun[trees] = beside(pool, spark, both, trees)
                    elif short and count not in finals:
                        while finals:
                            call_off(spark, finals.popitem()[1])
                        finals[count] = beside(pool, spark, final, count)
                while begun:
                    call_off(spark, begun.popitem()[1])
                if whole is not None:
                    model = first_trees(spark, whole, count)
                else:
                    model = finals.pop(count)[0].result() if count in finals else final(count)
            finally:
                for fit in [*begun.values(), *finals.values()]:
                    call_off(spark, fit)
        return Fit(model, count, errors)
    finally:
        train.unpersist()
        if held is not None:
            held.unpersist()


@dataclass
class Backtest:
    predictions: DataFrame
    metrics: DataFrame
    models: dict[int, PipelineModel] = field(default_factory=dict)
    fits: dict[int, Fit] = field(default_factory=dict)


def inputs_pipeline(numeric: list[str]) -> Pipeline:
    """Department as a categorical feature (unseen ones get their own bin) plus numbers."""
    return Pipeline(stages=[
        StringIndexer(inputCol=CATEGORY, outputCol=CODE, handleInvalid="keep"),
        VectorAssembler(inputCols=[CODE, *numeric], outputCol=FEATURES, handleInvalid="keep"),
    ])


def backtest_gbt(
    df: DataFrame, run_id: str, numeric: list[str] = NUMERIC_FEATURES,
    params: TreeParams = TreeParams(), minimum: int = MIN_TRAIN_ROWS, last_only: bool = False,
    parallel: int = 4,
) -> Backtest:
    """Fit on the years before, predict the year; ``parallel`` folds are fitted side by side.

    The last year before the test year chooses the number of trees and is trained on
    afterwards; nothing is tuned on the test year.
    """
    use_checkpoints(df.sparkSession)
    # Every tree reads the rows again: read them from files, not through the plan above.
    df = cut_lineage(df, "features")
    folds = walk_forward_folds(df, minimum).orderBy("fold").collect()  # one row per year
    if last_only:
        folds = folds[-1:]
    categories = df.agg(F.countDistinct(CATEGORY)).first()[0]
    if not folds:
        raise ValueError("no fold has enough history")
    known = drop_null(df, [TARGET])

    def fit(year: int) -> tuple[PipelineModel, Fit]:
        before = known.where(F.col("annee") < year)
        last = before.agg(F.max("annee")).first()[0]
        inputs = inputs_pipeline(numeric).fit(before)
        rows = inputs.transform(before).select(FEATURES, TARGET, "annee")
        done = fit_boosted(
            rows.where(F.col("annee") < last), rows.where(F.col("annee") == last), TARGET, params,
            bins=max(32, categories + 2), ahead=len(folds) == 1)
        return PipelineModel([*inputs.stages, done.model]), done

    years = [fold["annee_test"] for fold in folds]
    with ThreadPoolExecutor(parallel) as pool:
        made = dict(zip(years, pool.map(inheritable_thread_target(df.sparkSession)(fit), years)))
    pages, scores = [], []
    for year, (model, done) in made.items():
        test = known.where(F.col("annee") == year)
        predicted = model.transform(test).withColumnRenamed("prediction", "prix_m2_pred")
        pages.append(predictions_frame(predicted, run_id))
        used = {**params.__dict__, "fitted": done.trees}
        scores.append(metrics_frame(predicted, run_id, "gbt", 0, year, used))
    return Backtest(
        union_pages(pages), union_pages(scores), {y: m for y, (m, _) in made.items()},
        {y: f for y, (_, f) in made.items()})


def predictions_frame(predicted: DataFrame, run_id: str, actual: str = TARGET) -> DataFrame:
    """Predictions in the shape of their table."""
    return predicted.select(
        F.lit(run_id).alias("run_id"), ENTITY, F.col("annee").alias("annee_pred"),
        F.col("mois").alias("mois_pred"), F.col("prix_m2_pred").cast("float"),
        F.col(actual).cast("float").alias("prix_m2_reel"),
    )


def metrics_frame(
    predicted: DataFrame, run_id: str, model: str, horizon: int, year: int, params: dict,
    actual: str = TARGET,
) -> DataFrame:
    """Metrics of one fold in the shape of their table."""
    scored = error_metrics(predicted, actual, "prix_m2_pred", entity=ENTITY)
    return scored.select(
        F.lit(run_id).alias("run_id"), F.lit(model).alias("model_name"),
        F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("run_date"),
        "n_samples", "n_communes",
        *[F.col(c).cast("float").alias(c) for c in ("mae", "rmse", "mape")],
        F.lit(horizon).alias("horizon"), F.lit(year).alias("annee_test"),
        F.lit(params_json(params)).alias("params"),
    )


def feature_importance(model: PipelineModel, numeric: list[str], k: int = 20) -> DataFrame:
    """Gain importance of the last stage, greatest first; one row per feature."""
    gains = model.stages[-1].featureImportances.toArray()
    names = [CATEGORY, *numeric]
    rows = [(name, float(g)) for name, g in zip(names, [*gains, *[0.0] * (len(names) - len(gains))])]
    df = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(k)


def permutation_importance(
    df: DataFrame, model: PipelineModel, numeric: list[str], keys: list[str],
    blocks: int = 64, seed: int = 42,
) -> DataFrame:
    """Growth of the error when one feature is exchanged between rows of a block.

    Every row meets one donor row of its block, in one window; the model then predicts the
    row as it is and once for each feature taken from the donor, all in one pass, and one
    aggregate gives all errors. ``blocks`` is the number of random blocks at every size of
    the data; give a few per task, so that a block fits in one.

    This ranks features of a tree model; ``tree_contributions`` is the additive
    attribution.
    """
    trees = model.stages[-1]
    inputs = [CODE, *numeric]
    coded = model.stages[0].transform(df)
    scored = with_donors(coded.select(*keys, TARGET, *inputs), keys, inputs, blocks, seed)

    def vector(swapped: str | None):
        cells = [F.col(DONOR)[c] if c == swapped else F.col(c) for c in inputs]
        return array_to_vector(F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in cells]))

    for i, swapped in enumerate([None, *inputs]):
        one = trees.copy({trees.featuresCol: "_f", trees.predictionCol: f"_p{i}"})
        scored = one.transform(scored.withColumn("_f", vector(swapped))).drop("_f")
    errors = scored.agg(*[mae(TARGET, f"_p{i}").alias(f"_m{i}") for i in range(len(inputs) + 1)])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(f"_m{i}") - F.col("_m0")).alias("importance"))
        for i, c in enumerate([CATEGORY, *numeric], 1)])
    return errors.select(F.inline(rows))


def tree_contributions(
    df: DataFrame, model: PipelineModel, numeric: list[str], ids: list[str]
) -> DataFrame:
    """Additive contributions of every feature to the prediction of every row.

    ``contrib_<feature>`` for the department and all numbers, with ``base``, the mean
    prediction of the training rows as the trees hold it, and ``prediction``. They add up:
    base plus contributions is the prediction.
    """
    coded = model.stages[0].transform(df)
    features = {CATEGORY: F.col(CODE), **{c: F.col(c) for c in numeric}}
    return forest_contributions(coded, forest(model.stages[-1]), features, ids)


def prepare_sequences(
    df: DataFrame, features: list[str] = SEQUENCE_FEATURES, target: str = TARGET,
    entity: str = ENTITY, lookback: int = LOOKBACK, horizon: int = HORIZON,
    forward_only: bool = False, after: int = 2000,
) -> tuple[DataFrame, DataFrame]:
    """Scaled sequences with their split, and the scaler of every entity.

    ``x`` and ``y`` are scaled, ``y_actual`` is in the unit of the target. All features
    of a month are one array. The filled series is read three times (to count, to scale,
    to cut windows) and therefore written once.
    """
    place = F.lit(features.index(target))
    train_last, val_year, test_year = last_years(df)
    filled = cut_lineage(fill_monthly_vectors(df, entity, features, forward_only, after), "series")
    kept = eligible_entities(df, filled, entity, val_year, lookback, horizon).select(entity)
    filled = filled.join(kept, entity, "left_semi").withColumn("_actual", F.get(VECTOR, place))
    stats = cut_lineage(fit_vector_scaler(filled, entity, F.col("annee") < val_year), "scaler")
    scaled = scale_vectors(filled, stats, entity, len(features)).withColumn("_y", F.get(VECTOR, place))
    made = build_sequences(scaled, entity, VECTOR, {"y": "_y", "y_actual": "_actual"}, lookback, horizon)
    return temporal_split(made, train_last, val_year, test_year), stats


def forecast_multi_horizon(
    sequences: DataFrame, stats: DataFrame, run_id: str, place: int = 0,
    entity: str = ENTITY, horizon: int = HORIZON, params: TreeParams = TreeParams(),
    parallel: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """One regressor per horizon on the flattened window; predictions and metrics.

    Sequences of the validation year choose the number of trees of each horizon and are
    trained on afterwards; ``parallel`` horizons are fitted side by side. ``place`` is the target's among the features. The metrics have
    one row per horizon in the shape of their table: no MAPE, errors 0 where no actual is
    known, all test sequences and entities counted.
    """
    use_checkpoints(sequences.sparkSession)
    arrays = ["y", "y_actual", "y_periods"]
    flat = sequences.select(entity, "split", *arrays, F.flatten("x").alias("_x"))
    flat = cut_lineage(flat, "sequences").withColumn(FEATURES, array_to_vector("_x"))

    def fit(h: int) -> Fit:
        labelled = flat.select(FEATURES, F.element_at("y", h + 1).alias("_y"), "split")
        return fit_boosted(
            labelled.where("split = 'train'"), labelled.where("split = 'val'"), "_y", params)

    with ThreadPoolExecutor(parallel) as pool:
        run = inheritable_thread_target(sequences.sparkSession)(fit)
        fits = list(pool.map(run, range(horizon)))
    scored = flat.where("split = 'test'")
    for h, done in enumerate(fits):
        scored = done.model.setPredictionCol(f"_p{h}").transform(scored)
    scored = scored.withColumn("p", F.array(*[F.col(f"_p{h}") for h in range(horizon)]))
    rows = sequence_targets(scored, [entity], {"y_actual": "_v", "p": "_q"})
    rows = unscale_value(rows, stats, entity, "_q", place)
    predictions = rows.select(
        F.lit(run_id).alias("run_id"), F.col(entity).alias(ENTITY), "annee_pred", "mois_pred",
        "horizon", F.col("_q").cast("float").alias("prix_m2_pred"),
        positive_or_null("_v").cast("float").alias("prix_m2_reel"),
    )
    return predictions, horizon_metrics(predictions, {**params.__dict__, "fitted": [f.trees for f in fits]})


def horizon_metrics(predictions: DataFrame, params: dict, model: str = "gbt_horizon") -> DataFrame:
    """One row per run and horizon in the shape of the metrics table."""
    none = F.lit(0.0)
    scored = predictions.groupBy("run_id", "horizon").agg(
        F.count(F.lit(1)).alias("n_samples"), F.countDistinct(ENTITY).alias("n_communes"),
        F.coalesce(mae("prix_m2_reel", "prix_m2_pred"), none).cast("float").alias("mae"),
        F.coalesce(rmse("prix_m2_reel", "prix_m2_pred"), none).cast("float").alias("rmse"),
        F.max("annee_pred").cast("int").alias("annee_test"),
    )
    return scored.select(
        "run_id", F.lit(model).alias("model_name"),
        F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("run_date"),
        "n_samples", "n_communes", "mae", "rmse", F.lit(None).cast("float").alias("mape"),
        "horizon", "annee_test", F.lit(params_json(params)).alias("params"),
    )
