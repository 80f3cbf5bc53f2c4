"""Readers, writers, marks, incremental loads and streams.

The files these read are written from the given tables into the shared folder,
in the layouts of the sources.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from terrier.catalogue import roles
from terrier.catalogue.forecast import EXTRA, Wide, _naive, sql
from terrier.catalogue.parsing import compose
from terrier.catalogue.registry import ORACLES, QUERIES, query
from terrier.catalogue.roles import rnd, table
from terrier.catalogue.texts import TEXTS, text_table
from terrier.operators.rows import union_pages
from terrier.operators.series import positive_or_null, sequence_targets
from terrier.plans import forecasting as fc
from terrier.session import cut_lineage, fresh_path
from terrier.sources import commits, loaders, parsers, readers, sinks, state
from terrier.sources.schemas import TABLES, declare_table
from terrier.streaming import streams

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _declared(spark, spec: str) -> str:
    """A new empty table of a declared kind, its files in the shared folder."""
    name = _name(spec.strip("_"))
    return declare_table(spark, TABLES[spec], name, fresh_path(spark, name))


# --- readers -----------------------------------------------------------------------------

def _landed_csv(spark, sf, name: str, sep: str, gzip: bool = False) -> str:
    path = fresh_path(spark, name)
    writer = text_table(spark, sf, name).write.options(header=True, sep=sep, escape='"')
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)
    return path


@query("S01_read_csv_gz", compose('SELECT * REPLACE (nullif(valeur_fonciere, \'\') AS valeur_fonciere, '
                                  'nullif(surface_reelle_bati, \'\') AS surface_reelle_bati) FROM dvf_text'))
def read_csv_gz(spark, sf):
    path = _landed_csv(spark, sf, "dvf_text", ",", gzip=True)
    return readers.read_csv_gz(spark, path)


@query("S02_read_csv_semicolon", compose("SELECT * FROM rpls_text"))
def read_csv(spark, sf):
    return readers.read_csv(spark, _landed_csv(spark, sf, "rpls_text", ";"), ";")


@query("S03_read_plain_csv", compose(
    "SELECT * REPLACE (nullif(taux_pauvrete, '') AS taux_pauvrete) FROM insee_text"))
def read_plain_csv(spark, sf):
    return readers.read_plain_csv(spark, _landed_csv(spark, sf, "insee_text", ","))


def _landed_pages(spark, sf, name: str, key: str) -> str:
    """Pages as they land: one JSON object a line with its records under ``key``."""
    columns = list(TEXTS[name][1])
    path = fresh_path(spark, name)
    text_table(spark, sf, name).select(F.array(F.struct(*columns)).alias(key)).write.json(path)
    return path


def _record(name: str) -> str:
    return ", ".join(f"{c} STRING" for c in TEXTS[name][1])


@query("S04_read_json_offset_pages", compose("SELECT * FROM sitadel_text"))
def offset_pages(spark, sf):
    path = _landed_pages(spark, sf, "sitadel_text", "data")
    return readers.read_json_pages(spark, path, _record("sitadel_text"), lines=True)


@query("S05_read_json_numbered_pages", compose("SELECT * FROM ecln_text"))
def numbered_pages(spark, sf):
    path = _landed_pages(spark, sf, "ecln_text", "data")
    return readers.read_json_pages(spark, path, _record("ecln_text"), "data", lines=True)


@query("S06_read_json_cursor_pages", compose("SELECT * FROM dpe_text"))
def cursor_pages(spark, sf):
    path = _landed_pages(spark, sf, "dpe_text", "results")
    return readers.read_json_pages(spark, path, _record("dpe_text"), "results", lines=True)


def _catalogue(spark, sf):
    """A catalogue: one data file per event type, one vintage per day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    files = table(spark, sf, "events").select("event_type", day.alias("d")).distinct().groupBy(
        F.col("event_type").alias("rid")
    ).agg(F.collect_list(F.struct(F.col("d").alias("millesime"))).alias("millesimes"))
    return files.select(F.array(F.struct("rid", "millesimes")).alias("datafiles"))


_VINTAGES = "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS millesime FROM events WHERE event_type = 'view'"


@query("S07_catalog_vintages", _VINTAGES)
def vintages(spark, sf):
    return readers.catalog_vintages(_catalogue(spark, sf), "view")


@query("S08_latest_vintage", f"SELECT max(millesime) AS millesime FROM ({_VINTAGES})")
def latest(spark, sf):
    newest = readers.latest_vintage(_catalogue(spark, sf), "view")
    return spark.range(1).select(F.lit(newest).alias("millesime"))


# --- writers ----------------------------------------------------------------------------------

@query("S10_append_with_load_ts", compose("""
SELECT annee, count(*) AS n, count(DISTINCT id_mutation) AS mutations,
  (SELECT count(*) FROM raw_dvf) AS ecrites FROM raw_dvf GROUP BY 1"""))
def append(spark, sf):
    raw = roles.raw_dvf(spark, sf).drop("_loaded_at")
    name = _declared(spark, "raw_dvf")
    written = sinks.append_with_load_ts(raw, TABLES["raw_dvf"], name, AT)
    return spark.table(name).groupBy("annee").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id_mutation").alias("mutations"),
        F.lit(written).cast("bigint").alias("ecrites"))


@query("S11_declare_table", compose("SELECT annee, mois, code_commune, nb_logements_autorises "
                                    "FROM raw_sitadel"))
def declare(spark, sf):
    name = _declared(spark, "raw_sitadel")
    declare_table(spark, TABLES["raw_sitadel"], name)
    raw = roles.raw_sitadel(spark, sf).drop("_loaded_at")
    sinks.append_with_load_ts(raw, TABLES["raw_sitadel"], name, AT)
    return spark.table(name).select("annee", "mois", "code_commune", "nb_logements_autorises")


@query("S13_materialize", compose("SELECT annee, mois, code_commune, type_logement, "
                                  "nb_logements_autorises FROM raw_sitadel"))
def materialize(spark, sf):
    columns = ["annee", "mois", "code_commune", "type_logement", "nb_logements_autorises"]
    view = sinks.materialize(
        roles.raw_sitadel(spark, sf).select(*columns), _name("v_sitadel"), "view")
    return sinks.materialize(
        view, _name("t_sitadel"), "table", ["annee", "code_commune", "mois"], "annee",
        fresh_path(spark, "t_sitadel"),
    ).select(*columns)


@query("S14_write_predictions", sql("""
SELECT 'essai' AS run_id, code_commune, annee AS annee_pred, mois AS mois_pred,
  prix_m2_lag_1m::FLOAT AS prix_m2_pred, prix_m2_med::FLOAT AS prix_m2_reel FROM loaded_dense"""))
def write_predictions(spark, sf):
    name = _declared(spark, "preds_ml_prix_m2")
    sinks.write_predictions(fc.predictions_frame(_naive(spark, sf), "essai"), False, name)
    return spark.table(name).drop("predicted_at")


_E = "prix_m2_lag_1m - prix_m2_med"


@query("S15_write_metrics", sql(f"""
SELECT 'essai' AS run_id, 'naif' AS model_name, count(*) AS n_samples,
  count(DISTINCT code_commune) AS n_communes, {rnd(f'avg(abs({_E}))', 4)}::FLOAT AS mae,
  {rnd(f'sqrt(avg(power({_E}, 2)))', 4)}::FLOAT AS rmse,
  {rnd(f'avg(abs(({_E}) / prix_m2_med)) * 100', 4)}::FLOAT AS mape, 0 AS horizon,
  annee AS annee_test, '{{"retard": 1}}' AS params FROM loaded_dense GROUP BY annee"""))
def write_metrics(spark, sf):
    """One row per fold, as the backtest writes them."""
    name = _declared(spark, "model_perf_runs")
    naive = cut_lineage(_naive(spark, sf), "naive")
    years = [r.annee for r in naive.select("annee").distinct().collect()]  # one row per year
    pages = [fc.metrics_frame(naive.where(F.col("annee") == y), "essai", "naif", 0, y, {"retard": 1})
             for y in sorted(years)]
    sinks.write_metrics(union_pages(pages), name)
    return spark.table(name).drop("run_date", "logged_at")


def _naive_horizons(spark, sf):
    """Horizon predictions in the shape of their table: the last known month for all ahead."""
    test = Wide(spark, sf).split().where("split = 'test'")
    last = F.get(F.element_at("x", -1), F.lit(0))
    ahead = test.withColumns({"p": F.array(last, last, last), "a": F.col("y")})
    targets = sequence_targets(ahead, ["code_commune"], {"a": "_v", "p": "_q"})
    return targets.select(
        F.lit("essai").alias("run_id"), "code_commune", "annee_pred", "mois_pred", "horizon",
        F.col("_q").cast("float").alias("prix_m2_pred"),
        positive_or_null("_v").cast("float").alias("prix_m2_reel"))


EXTRA["split_last"] = (
    "SELECT s.*, k.prix_m2_med AS y0 FROM split_wide s JOIN (SELECT code_commune, "
    "lead(periode) OVER (PARTITION BY code_commune ORDER BY periode) AS periode, prix_m2_med "
    "FROM kept_wide) k USING (code_commune, periode)")

_AHEAD = " UNION ALL ".join(
    f"SELECT 'essai' AS run_id, code_commune, (p{h} // 100)::INTEGER AS annee_pred, "
    f"(p{h} % 100)::INTEGER AS mois_pred, {h} AS horizon, y0::FLOAT AS prix_m2_pred, "
    f"CASE WHEN y{h} > 0 THEN y{h} END::FLOAT AS prix_m2_reel FROM split_last WHERE split = 'test'"
    for h in (1, 2, 3))
@query("S14_write_horizon_predictions", sql(_AHEAD))
def write_horizon_predictions(spark, sf):
    name = _declared(spark, "preds_lstm_prix_m2")
    sinks.write_predictions(_naive_horizons(spark, sf), True, name)
    return spark.table(name).drop("predicted_at")


_MEAN_ERROR = "avg(abs(prix_m2_pred::DOUBLE - prix_m2_reel::DOUBLE))"
_ROOT_ERROR = "sqrt(avg(power(prix_m2_pred::DOUBLE - prix_m2_reel::DOUBLE, 2)))"


@query("S15_write_horizon_metrics", sql(f"""
SELECT run_id, 'naif' AS model_name, count(*) AS n_samples, count(DISTINCT code_commune) AS n_communes,
  {rnd(_MEAN_ERROR, 4)}::FLOAT AS mae, {rnd(_ROOT_ERROR, 4)}::FLOAT AS rmse, NULL::FLOAT AS mape,
  horizon, max(annee_pred)::INTEGER AS annee_test, '{{"retard": 1}}' AS params
FROM ({_AHEAD}) GROUP BY run_id, horizon"""))
def write_horizon_metrics(spark, sf):
    """Metrics of the predictions as they were written and read back."""
    written = write_horizon_predictions(spark, sf)
    name = _declared(spark, "model_perf_runs")
    sinks.write_metrics(fc.horizon_metrics(written, {"retard": 1}, "naif"), name)
    return spark.table(name).drop("run_date", "logged_at")


# --- marks ---------------------------------------------------------------------------------

def _marks(spark, sf):
    """State rows: every event moves the mark of its type to its day."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.date_format("ts", "yyyy-MM-dd").alias("last_value"),
        F.col("ts").cast("timestamp").alias("updated_at"))


@query("I01_get_watermark", """
SELECT event_type AS source, arg_max(strftime(ts, '%Y-%m-%d'), ts) AS last_value FROM events GROUP BY 1""")
def get_watermark(spark, sf):
    return state.current_marks(_marks(spark, sf)).select("source", "last_value")


@query("I02_set_watermark", """
SELECT 'events' AS source, strftime(max(ts), '%Y-%m-%d') AS last_value FROM events""")
def set_watermark(spark, sf):
    name = _declared(spark, state.STATE)
    mark = state.max_mark(table(spark, sf, "events"), "date", "ts").first()["last_value"]
    state.set_watermark(spark, "events", "2000-01-01", name)
    state.set_watermark(spark, "events", mark, name)
    return state.current_marks(spark.table(name)).select("source", "last_value")


def _orders_by_month(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("jour"), F.year("o_orderdate").alias("annee"),
        F.month("o_orderdate").alias("mois"), F.quarter("o_orderdate").alias("trimestre"))


_BY_MONTH = """SELECT o_orderkey, o_orderdate::DATE AS jour, year(o_orderdate)::INTEGER AS annee,
  month(o_orderdate)::INTEGER AS mois, quarter(o_orderdate)::INTEGER AS trimestre FROM orders"""


@query("I03_years_to_load", f"SELECT * FROM ({_BY_MONTH}) WHERE annee > 1997 AND annee <= 2000")
def years_to_load(spark, sf):
    return state.since_year(_orders_by_month(spark, sf), "annee", 1997, 2000)


@query("I04_since_next_day", f"SELECT * FROM ({_BY_MONTH}) WHERE jour >= DATE '1998-03-01'")
def since_next_day(spark, sf):
    return state.since_next_day(_orders_by_month(spark, sf), "jour", "1998-02-28")


@query("I05_since_year_month", f"SELECT * FROM ({_BY_MONTH}) WHERE (annee, mois) > (1999, 5)")
def since_year_month(spark, sf):
    return state.since_year_month(
        _orders_by_month(spark, sf), state.year_month_mark("1999-05"))


@query("I06_since_quarter", f"""
SELECT *, annee || '-T' || trimestre AS periode FROM ({_BY_MONTH})
WHERE annee || '-T' || trimestre > '1999-T3'""")
def since_quarter(spark, sf):
    df = _orders_by_month(spark, sf).withColumn(
        "periode", F.concat("annee", F.lit("-T"), "trimestre"))
    return state.since_quarter(df, "periode", "1999-T3")


@query("I07_since_month", f"SELECT * FROM ({_BY_MONTH}) WHERE jour > DATE '1999-06-01'")
def since_month(spark, sf):
    return state.since_month(_orders_by_month(spark, sf), "jour", "1999-06")


@query("I08_new_vintages", f"SELECT * FROM ({_VINTAGES}) WHERE millesime > '2024-01-20'")
def new_vintages(spark, sf):
    return state.new_vintages(vintages(spark, sf), "2024-01-20")


@query("I09_skip_if_same_vintage", """
SELECT event_type AS source, max(strftime(ts, '%Y-%m-%d')) = (SELECT max(strftime(ts, '%Y-%m-%d'))
  FROM events) AS a_jour FROM events GROUP BY 1""")
def skip_same(spark, sf):
    newest = readers.latest_vintage(_catalogue(spark, sf), "view")
    marks = state.current_marks(_marks(spark, sf))
    return marks.select("source", (F.col("last_value") == newest).alias("a_jour"))


@query("I10_max_mark", f"""
SELECT 'date' AS sorte, strftime(max(jour), '%Y-%m-%d') AS last_value FROM ({_BY_MONTH})
UNION ALL SELECT 'month', strftime(max(jour), '%Y-%m') FROM ({_BY_MONTH})
UNION ALL SELECT 'year_month', strftime(max(jour), '%Y-%m') FROM ({_BY_MONTH})
UNION ALL SELECT 'quarter', max(annee || '-T' || trimestre) FROM ({_BY_MONTH})""")
def max_mark(spark, sf):
    df = _orders_by_month(spark, sf)
    marks = [state.max_mark(df, kind, column).select(F.lit(kind).alias("sorte"), "last_value")
             for kind, column in (("date", "jour"), ("month", "jour"), ("year_month", None),
                                  ("quarter", None))]
    one, *rest = marks
    for other in rest:
        one = one.unionByName(other)
    return one


# --- loads ------------------------------------------------------------------------------------

@query("I11_incremental_load", compose("""
SELECT 'premier' AS passage, count(*) AS lignes, strftime(max(d), '%Y-%m-%d') AS marque FROM (
  SELECT TRY_CAST(CASE WHEN date_etablissement_dpe <> '2024-02-30' THEN date_etablissement_dpe END
    AS DATE) AS d FROM dpe_text) WHERE d >= DATE '1998-01-01'
UNION ALL SELECT 'second', 0, strftime(max(d), '%Y-%m-%d') FROM (
  SELECT TRY_CAST(CASE WHEN date_etablissement_dpe <> '2024-02-30' THEN date_etablissement_dpe END
    AS DATE) AS d FROM dpe_text)"""))
def incremental(spark, sf):
    """Two runs of one load: the second finds nothing after the mark."""
    path = _landed_pages(spark, sf, "dpe_text", "results")
    raw, marks = _declared(spark, "raw_dpe"), _declared(spark, state.STATE)
    record = _record("dpe_text")

    def units(session, mark):
        parsed = parsers.parse_dpe(
            readers.read_json_pages(session, path, record, "results", lines=True))
        fresh = state.since_next_day(parsed, "date_etablissement_dpe", mark, "1998-01-01")
        yield loaders.Unit(fresh, state.mark_of("date", "date_etablissement_dpe"))

    spec = loaders.SourceSpec("dpe", "raw_dpe", units)
    out = []
    for label in ("premier", "second"):
        n = loaders.incremental_load(spark, spec, table=raw, state=marks)
        mark = state.current_marks(spark.table(marks))
        out.append(mark.select(
            F.lit(label).alias("passage"), F.lit(n).cast("bigint").alias("lignes"),
            F.col("last_value").alias("marque")))
    return out[0].unionByName(out[1])


@query("I12_full_reload", compose("""
SELECT annee, zone_code, zone_libelle, nb_terrains, nb_maisons FROM stg_eptb"""))
def reload(spark, sf):
    """Loaded twice; the newest version of every row is read."""
    from terrier.plans.staging import stg_eptb

    rows = parsers.parse_eptb(*roles.land_and_houses(spark, sf))
    name = _declared(spark, "raw_eptb")
    for _ in range(2):
        loaders.full_reload(spark, rows, "raw_eptb", name=name)
    return stg_eptb(spark.table(name)).select(
        "annee", "zone_code", "zone_libelle", "nb_terrains", "nb_maisons")


# --- committed loads: one for every source ------------------------------------------------------

def _ledger(spark, table_name: str) -> commits.Ledger:
    """A new raw table with its own commits, in the shared folder."""
    name = _name("commits")
    declare_table(spark, TABLES[commits.COMMITS], name, fresh_path(spark, name))
    return commits.Ledger(TABLES[table_name], fresh_path(spark, table_name), name)


def _landed_years(spark, sf, name: str, year: str, gzip: bool = False):
    """One folder of CSV a year; rows without a year lie with the first one."""
    path = fresh_path(spark, name)
    rows_ = text_table(spark, sf, name).withColumn("_y", F.expr(year))
    least, most = rows_.agg(F.min("_y"), F.max("_y")).first()
    writer = rows_.fillna(least, ["_y"]).write.partitionBy("_y").options(header=True, sep=",", escape='"')
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)
    return (lambda y: f"{path}/_y={y}"), least, most


def _loaded_once(
    spark, sf, source: loaders.SourceSpec, ledger: commits.Ledger, kind: str, since=None, again=True
):
    """A load that dies before its commit, the load again, and a third run that finds nothing."""
    for unit in source.units(spark, since):
        ledger.stage(unit.rows, "lost")
        break
    commits.committed_load(spark, source, ledger, since=since)
    if again:
        commits.committed_load(spark, source, ledger)
    return ledger.read(spark).select(*QUERIES[f"T08_parse_{kind}"](spark, sf).columns)


@query("I11_committed_dvf", ORACLES["T08_parse_dvf"])
def committed_dvf(spark, sf):
    path, least, most = _landed_years(
        spark, sf, "dvf_text", "year(try_to_date(substr(date_mutation, 1, 10)))", True)
    return _loaded_once(
        spark, sf, loaders.dvf(path, most), _ledger(spark, "raw_dvf"), "dvf", str(least - 1))


@query("I11_committed_insee", ORACLES["T08_parse_insee"])
def committed_insee(spark, sf):
    path, least, most = _landed_years(spark, sf, "insee_text", "try_cast(annee AS INT)")
    return _loaded_once(
        spark, sf, loaders.insee(path, most), _ledger(spark, "raw_insee_communes"), "insee",
        str(least - 1))


@query("I11_committed_dpe", ORACLES["T08_parse_dpe"].replace(
    "SELECT numero_dpe", "SELECT * FROM (SELECT numero_dpe")
    + ") WHERE date_etablissement_dpe >= DATE '1998-01-01'")
def committed_dpe(spark, sf):
    path = _landed_pages(spark, sf, "dpe_text", "results")
    return _loaded_once(
        spark, sf, loaders.dpe(path, lines=True), _ledger(spark, "raw_dpe"), "dpe", "1997-12-31")


def _without_mark(name: str) -> str:
    """SQL of a whole parse: the statement of the marked one without its last condition."""
    text = ORACLES[name]
    return text[: text.rindex("WHERE")].rstrip()


@query("I11_committed_sitadel", _without_mark("T08_parse_sitadel"))
def committed_sitadel(spark, sf):
    path, ledger = _landed_csv(spark, sf, "sitadel_text", ";"), _ledger(spark, "raw_sitadel")
    source = loaders.sitadel(lambda _: path, "2024-01", state=ledger.commits)
    return _loaded_once(spark, sf, source, ledger, "sitadel")


@query("I11_committed_ecln", _without_mark("T08_parse_ecln"))
def committed_ecln(spark, sf):
    """An unreadable quarter sorts after every mark: a third run would load it again, for the
    replacing key to absorb."""
    path = _landed_pages(spark, sf, "ecln_text", "data")
    return _loaded_once(
        spark, sf, loaders.ecln(path, lines=True), _ledger(spark, "raw_ecln"), "ecln", again=False)


@query("I11_committed_rpls", ORACLES["T08_parse_rpls"])
def committed_rpls(spark, sf):
    path = _landed_csv(spark, sf, "rpls_text", ";")
    vintages_ = spark.range(1).select(F.lit("2024-01").alias("millesime"))
    return _loaded_once(
        spark, sf, loaders.rpls(lambda _: path, vintages_), _ledger(spark, "raw_rpls"), "rpls")


@query("I11_committed_macro", _without_mark("T08_parse_macro") + "\nWHERE d IS NOT NULL")
def committed_macro(spark, sf):
    path = _landed_csv(spark, sf, "macro_text", ",")
    return _loaded_once(
        spark, sf, loaders.macro(path), _ledger(spark, "raw_macro_taux"), "macro")


@query("I12_committed_eptb", ORACLES["T08_parse_eptb"])
def committed_eptb(spark, sf):
    """Reloaded twice: the second state replaces the first."""
    ledger = _ledger(spark, "raw_eptb")
    parsed = QUERIES["T08_parse_eptb"](spark, sf)
    for _ in range(2):
        commits.committed_reload(spark, parsed, ledger, "eptb")
    return ledger.read(spark).select(*parsed.columns)


# --- streams -------------------------------------------------------------------------------------

def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return streams.read_landing(spark, f"{sf}/events.parque[t]", schema)


@query("X01_stream_ingest", compose("SELECT id_mutation, id_parcelle, valeur_fonciere FROM raw_dvf"))
def stream_ingest(spark, sf):
    landed = fresh_path(spark, "landing")
    raw = roles.raw_dvf(spark, sf).drop("_loaded_at")
    raw.write.parquet(landed)
    name = _declared(spark, "raw_dvf")
    for _ in range(2):  # the second run finds no new files
        streams.stream_ingest(
            streams.read_landing(spark, landed, raw.schema), TABLES["raw_dvf"], lambda b: b,
            landed + "-checkpoint", name).awaitTermination()
    return spark.table(name).select("id_mutation", "id_parcelle", "valeur_fonciere")


@query("X01_ingest_once", compose("SELECT id_mutation, id_parcelle, valeur_fonciere FROM raw_dvf"))
def ingest_once(spark, sf):
    """Several batches; the last one runs a second time, as after a crash before its checkpoint."""
    landed = fresh_path(spark, "landing")
    raw = roles.raw_dvf(spark, sf).drop("_loaded_at")
    raw.write.option("maxRecordsPerFile", max(1, raw.count() // 4)).parquet(landed)
    ledger = _ledger(spark, "raw_dvf")
    stream = streams.read_landing(spark, landed, raw.schema, files_per_batch=3)
    query_ = commits.ingest_once(stream, ledger, lambda b: b, landed + "-checkpoint", "lots")
    query_.awaitTermination()
    last = ledger.committed(spark).agg(F.max(commits.UNIT)).first()[0]
    attempt = spark.read.parquet(ledger.path).where(F.col(commits.UNIT) == last)
    again = cut_lineage(attempt.select(*raw.columns), "batch")
    commits.load_batch(spark, again, ledger, "lots", int(last.rsplit("-", 1)[1]))
    return ledger.read(spark).select("id_mutation", "id_parcelle", "valeur_fonciere")


@query("X02_stream_dedup", """
SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)
GROUP BY ALL""")
def stream_dedup(spark, sf):
    """Pairs come again in every batch, at any distance; the sink keeps each once."""
    events = table(spark, sf, "events").select("user_id", "event_type", "ts")
    landed = fresh_path(spark, "events")
    events.repartition(8, "ts").write.parquet(landed)
    stream = streams.read_landing(spark, landed, events.schema, files_per_batch=2)
    path = fresh_path(spark, "first")
    kept = streams.run_to_first_rows(
        stream, path, path + "-checkpoint", ["user_id", "event_type"], ["ts"])
    return kept.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("X03_stream_tumbling_panel", f"""
SELECT date_trunc('day', ts)::DATE AS jour, event_type, count(*) AS n,
  {rnd('sum(value)', 2)} AS total FROM events GROUP BY ALL""")
def stream_panel(spark, sf):
    """All windows, closed or not: a batch writes the windows it changed."""
    stream = streams.stream_tumbling_panel(
        _event_stream(spark, sf), "ts", "value", ["event_type"], "1 day", "1 day")
    path = fresh_path(spark, "panel")
    made = streams.run_to_versions(stream, path, path + "-checkpoint", ["debut", "event_type"])
    return made.select(
        F.to_date("debut").alias("jour"), "event_type", "n",
        (F.rint(F.rint(F.col("total") * 1e6) / 1e6 * 100) / 100).alias("total"))
