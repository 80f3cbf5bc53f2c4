import json
import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from terrier.sources import commits, loaders, parsers, readers, sinks, state
from terrier.sources.schemas import TABLES, declare_table
from terrier.streaming import streams


def fresh(label):
    return f"{label}_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def names(spark):
    made = {"raw": fresh("raw"), "state": fresh("marks")}
    yield made
    for name in made.values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def mark_of(spark, names, source):
    return state.get_watermark(spark, source, names["state"])


def test_years():
    assert state.years_to_load(None, 2023) == [2021, 2022, 2023]
    assert state.years_to_load("2022", 2024) == [2023, 2024]
    assert state.years_to_load("2024", 2024) == []
    assert state.years_to_load(None, 2018, 2017) == [2017, 2018]


def test_month_mark():
    assert state.year_month_mark("2024-03") == (2024, 3)
    assert state.year_month_mark(None) is None and state.year_month_mark("bad") is None


def test_watermark_is_the_newest(spark, names):
    state.ensure_state(spark, names["state"])
    assert mark_of(spark, names, "dvf") is None
    state.set_watermark(spark, "dvf", "2021", names["state"])
    state.set_watermark(spark, "dpe", "2024-01-01", names["state"])
    state.set_watermark(spark, "dvf", "2022", names["state"])
    assert mark_of(spark, names, "dvf") == "2022" and mark_of(spark, names, "dpe") == "2024-01-01"


def yearly(tmp_path, years=(2021, 2022)):
    for y in years:
        write(f"{tmp_path}/{y}.csv", "id_mutation,date_mutation,valeur_fonciere,code_commune,extra\n"
              f"{y}-1,{y}-06-15,\"350 000,50\",75056,x\n{y}-2,{y}-07-01,bad,69123,y\n")
    return lambda y: f"{tmp_path}/{y}.csv"


def test_yearly_load(spark, names, tmp_path):
    spec = loaders.dvf(yearly(tmp_path), 2022)
    load = dict(table=names["raw"], state=names["state"])
    assert loaders.incremental_load(spark, spec, dry_run=True, **load) == 0
    assert mark_of(spark, names, "dvf") is None
    assert loaders.incremental_load(spark, spec, **load) == 4
    assert mark_of(spark, names, "dvf") == "2022"
    assert loaders.incremental_load(spark, spec, **load) == 0
    table = spark.table(names["raw"])
    assert table.count() == 4 and table.where("_loaded_at IS NULL").count() == 0
    assert table.where("valeur_fonciere = 350000.5").count() == 2
    one_year = loaders.dvf(yearly(tmp_path), 2022, year=2021)
    assert loaders.incremental_load(spark, one_year, keep_mark=True, **load) == 2
    assert mark_of(spark, names, "dvf") == "2022"
    assert loaders.incremental_load(spark, spec, full_refresh=True, **load) == 4


def test_mark_stays_when_the_write_fails(spark, names, tmp_path):
    yearly(tmp_path, (2021,))
    spec = loaders.dvf(lambda y: f"{tmp_path}/{y}.csv", 2022)
    with pytest.raises(Exception):
        loaders.incremental_load(spark, spec, table=names["raw"], state=names["state"])
    assert mark_of(spark, names, "dvf") == "2021"


def page(path, records, key="data", **envelope):
    return write(path, json.dumps({key: records, **envelope}))


def test_pages(spark, tmp_path):
    page(f"{tmp_path}/p/1.json", [{"a": "1", "z": 1}, {"a": "2"}], total=3)
    page(f"{tmp_path}/p/2.json", [{"a": "3"}], total=3)
    page(f"{tmp_path}/p/3.json", [], total=3)
    got = readers.read_json_pages(spark, f"{tmp_path}/p", "a STRING")
    assert sorted(r.a for r in got.collect()) == ["1", "2", "3"]
    page(f"{tmp_path}/c/1.json", [{"a": "9"}], "results", next="u")
    assert readers.read_json_pages(spark, f"{tmp_path}/c", "a STRING", "results").first().a == "9"


def test_dpe_load(spark, names, tmp_path):
    rec = lambda n, d: {"numero_dpe": n, "date_etablissement_dpe": d, "code_insee_ban": "75056"}
    page(f"{tmp_path}/d/1.json", [rec("1", "2020-01-01"), rec("2", "2023-04-12")], "results")
    load = dict(table=names["raw"], state=names["state"])
    spec = loaders.dpe(f"{tmp_path}/d")
    assert loaders.incremental_load(spark, spec, **load) == 1
    assert mark_of(spark, names, "dpe") == "2023-04-12"
    page(f"{tmp_path}/d/2.json", [rec("3", "2023-04-12"), rec("4", "2023-04-13")], "results")
    assert loaders.incremental_load(spark, spec, **load) == 1
    assert mark_of(spark, names, "dpe") == "2023-04-13"
    assert loaders.incremental_load(spark, spec, since="2023-04-11", keep_mark=True, **load) == 3
    whole = loaders.dpe(f"{tmp_path}/d", full_refresh=True)
    assert loaders.incremental_load(spark, whole, full_refresh=True, **load) == 4


def test_sitadel_load(spark, names, tmp_path):
    head = "ANNEE;MOIS;CODE_INSEE;TYPE_LGT;LOG_AUT\n"
    write(f"{tmp_path}/v1.csv", head + "2024;02;01001;T;5\n2024;03;01001;T;6\n")
    write(f"{tmp_path}/v2.csv", head + "2024;03;01001;T;6\n2024;04;01001;T;7\n")
    path_of = lambda v: f"{tmp_path}/{v}.csv"
    load = dict(table=names["raw"], state=names["state"])

    def run(vintage, full=False):
        spec = loaders.sitadel(path_of, vintage, full, names["state"])
        return loaders.incremental_load(spark, spec, full_refresh=full, **load)

    assert run("v1") == 2 and mark_of(spark, names, "sitadel") == "2024-03"
    assert run("v1") == 0
    assert run("v2") == 1 and mark_of(spark, names, "sitadel") == "2024-04"
    assert run("v2", True) == 2


def catalogue(spark, tmp_path, vintages):
    write(f"{tmp_path}/cat.json", json.dumps({"datafiles": [
        {"rid": "other", "millesimes": [{"millesime": "2030-01"}]},
        {"rid": "r", "millesimes": [{"millesime": v} for v in vintages]}]}))
    return readers.read_catalogue(spark, f"{tmp_path}/cat.json")


def test_vintages(spark, tmp_path):
    cat = catalogue(spark, tmp_path, ["2024-01", "2022-01", "2023-01"])
    found = [r.millesime for r in readers.catalog_vintages(cat, "r").collect()]
    assert found == ["2022-01", "2023-01", "2024-01"]
    assert readers.latest_vintage(cat, "r") == "2024-01"
    assert readers.catalog_vintages(cat, "absent").count() == 0
    with pytest.raises(LookupError):
        readers.latest_vintage(cat, "absent")


def test_rpls_load(spark, names, tmp_path):
    for v in ("2023-01", "2024-01"):
        write(f"{tmp_path}/{v}.csv", "DEPCOM;FINAN_CODE;CONSTRUCT\n75056;PLS;1985\n75056;PLUS;NC\n")
    cat = readers.catalog_vintages(catalogue(spark, tmp_path, ["2024-01", "2023-01"]), "r")
    spec = loaders.rpls(lambda v: f"{tmp_path}/{v}.csv", cat)
    load = dict(table=names["raw"], state=names["state"])
    assert loaders.incremental_load(spark, spec, **load) == 4
    assert mark_of(spark, names, "rpls") == "2024-01"
    assert loaders.incremental_load(spark, spec, **load) == 0
    years = {r.annee for r in spark.table(names["raw"]).select("annee").distinct().collect()}
    assert years == {2023, 2024}


def test_ecln_macro_insee_eptb(spark, names, tmp_path):
    load = dict(table=names["raw"], state=names["state"])
    page(f"{tmp_path}/e/1.json", [{"TRIMESTRE": "2024-T3", "DEP_CODE": "75"},
                                  {"TRIMESTRE": "2024-T2", "DEP_CODE": "75"}])
    assert loaders.incremental_load(spark, loaders.ecln(f"{tmp_path}/e"), **load) == 2
    assert mark_of(spark, names, "ecln") == "2024-T3"
    assert loaders.incremental_load(spark, loaders.ecln(f"{tmp_path}/e"), **load) == 0
    spark.sql(f"DROP TABLE {names['raw']}")
    write(f"{tmp_path}/m.csv", "date,taux_inflation\n2024-11-01,\"1,8\"\nbad,1\n")
    assert loaders.incremental_load(spark, loaders.macro(f"{tmp_path}/m.csv"), **load) == 1
    assert mark_of(spark, names, "macro_taux") == "2024-11"
    spark.sql(f"DROP TABLE {names['raw']}")
    write(f"{tmp_path}/i/2017.csv", "code_commune,annee,superficie\n01001,2017,\"15,32\"\n")
    spec = loaders.insee(lambda y: f"{tmp_path}/i/{y}.csv", 2017)
    assert loaders.incremental_load(spark, spec, **load) == 1
    spark.sql(f"DROP TABLE {names['raw']}")
    page(f"{tmp_path}/l/1.json", [{"ANNEE": "2024", "ZONE_CODE": "11", "NB_TERRAINS": "3"}])
    page(f"{tmp_path}/h/1.json", [{"ANNEE": "2024", "ZONE_CODE": "76", "NB_MAISONS": "4"}])
    rows = loaders.eptb(spark, f"{tmp_path}/l", f"{tmp_path}/h")
    assert loaders.full_reload(spark, rows, "raw_eptb", dry_run=True) == 0
    assert loaders.full_reload(spark, rows, "raw_eptb", name=names["raw"]) == 2


def test_append_leaves_the_input_and_skips_empty(spark, names):
    df = spark.createDataFrame([("a", "b")], "source STRING, last_value STRING")
    spec = TABLES["_ingestion_watermarks"]
    assert sinks.append_with_load_ts(df, spec, names["raw"]) == 1
    assert df.columns == ["source", "last_value"]
    assert sinks.append_with_load_ts(df.limit(0), spec, names["raw"]) == 0
    assert spark.table(names["raw"]).count() == 1


def test_declared_tables(spark, names):
    for spec in TABLES.values():
        assert set(spec.keys) <= set(spec.data_columns) and set(spec.ties) <= set(spec.data_columns)
    declare_table(spark, TABLES["raw_dpe"], names["raw"])
    declare_table(spark, TABLES["raw_dpe"], names["raw"])
    assert set(spark.table(names["raw"]).columns) == set(TABLES["raw_dpe"].schema.fieldNames())


def test_materialize_table(spark, names):
    df = spark.range(100).select((F.col("id") % 3).cast("int").alias("annee"), F.col("id").alias("k"))
    out = sinks.materialize(df, names["raw"], "table", ["annee", "k"], "annee")
    assert out.count() == 100
    pruned = out.where("annee = 1")
    assert pruned.count() == 33
    assert "PartitionFilters: [isnotnull(annee" in pruned._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning")


def test_bucketed_tables_need_no_exchange(spark, names, tmp_path):
    from terrier.plans import staging, warehouse

    raw = spark.range(2000).selectExpr(
        "cast(id % 700 AS STRING) AS id_mutation", "cast(id % 3 AS STRING) AS id_parcelle", "2021 AS annee",
        "cast(id % 50 AS STRING) AS code_commune", "1000D + id AS valeur_fonciere", "timestamp_seconds(id) AS _loaded_at")
    spec = TABLES["raw_dvf"]
    full = raw.select(*[
        (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    table = sinks.bucketed(full, names["raw"], ["id_mutation"], 4, location=f"{tmp_path}/b")
    plain, laid = staging.stg_dvf(full), staging.stg_dvf(table)
    assert exchanges(laid) == 0 and exchanges(plain) == 1
    assert laid.exceptAll(plain).count() == 0 and laid.count() == plain.count()

    keys = warehouse.COMMUNE_YEAR
    right = full.groupBy(*keys).agg(F.max("valeur_fonciere").alias("most"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = sinks.bucketed(full, names["state"], keys, 4, location=f"{tmp_path}/a")
        b = sinks.bucketed(right, names["state"] + "_c", keys, 4, location=f"{tmp_path}/c")
        joined = a.join(b, keys, "left")
        assert exchanges(joined) == 0 and joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE IF EXISTS {names['state']}_c")


def test_filters_reach_the_scan(spark, data):
    df = spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey", "o_orderdate", "o_orderstatus")
    text = state.since_next_day(df, "o_orderdate", "1999-01-01").select(
        "o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text and "o_orderstatus" not in text


def test_stream_dedup_and_late_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 00:01:00")],
        "k STRING, ts STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.parquet(f"{tmp_path}/in")
    stream = streams.read_landing(spark, f"{tmp_path}/in", df.schema)
    out = streams.run_to_table(
        streams.stream_dedup(stream, ["k"], "ts", "1 hour").select("k"), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert sorted(r.k for r in out.collect()) == ["a", "b"]


def test_first_rows_at_any_distance(spark, tmp_path):
    days = [(f"2020-01-{d:02d} 00:00:00", k, d) for d in range(1, 29, 3) for k in ("a", None, f"k{d % 2}")]
    for n, (ts, k, d) in enumerate(days):
        spark.createDataFrame([(k, ts, d)], "k STRING, ts STRING, v INT").coalesce(1).write.parquet(f"{tmp_path}/in/{n:03d}")
    schema = spark.createDataFrame([], "k STRING, ts STRING, v INT").schema
    stream = streams.read_landing(spark, f"{tmp_path}/in/*", schema, files_per_batch=5)
    out = streams.run_to_first_rows(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["k"], ["ts"])
    got = sorted(((r.k or "", r.v) for r in out.collect()))
    assert [k for k, _ in got] == ["", "a", "k0", "k1"]
    assert len([x for x in os.listdir(f"{tmp_path}/out") if x.startswith("_batch=")]) >= 6
    # A run that goes on later leaves known keys as they are.
    spark.createDataFrame([("a", "2019-01-01 00:00:00", 99), ("z", "2030-01-01 00:00:00", 7)], schema).coalesce(1).write.parquet(f"{tmp_path}/in/999")
    stream = streams.read_landing(spark, f"{tmp_path}/in/*", schema, files_per_batch=5)
    out = streams.run_to_first_rows(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["k"], ["ts"])
    assert sorted(((r.k or "", r.v) for r in out.collect())) == sorted([*got, ("z", 7)])


@pytest.fixture
def ledger(names, tmp_path):
    return commits.Ledger(TABLES["raw_dvf"], f"{tmp_path}/ledger", names["state"])


def lots(spark, ids, year=2021):
    return spark.createDataFrame([(str(i), year) for i in ids], "id_mutation STRING, annee INT")


def test_a_load_that_dies_before_its_commit_counts_once(spark, names, tmp_path, ledger):
    spec = loaders.dvf(yearly(tmp_path), 2022)
    died = next(iter(spec.units(spark, None)))
    ledger.stage(died.rows, "lost")
    assert ledger.read(spark).count() == 0 and mark_of(spark, names, "dvf") is None
    assert commits.committed_load(spark, spec, ledger) == 4
    assert mark_of(spark, names, "dvf") == "2022"
    got = ledger.read(spark)
    assert got.count() == 4 and got.select("id_mutation").distinct().count() == 4
    assert got.columns == TABLES["raw_dvf"].schema.fieldNames()
    assert commits.committed_load(spark, spec, ledger) == 0
    assert commits.committed_load(spark, spec, ledger, full_refresh=True) == 4


def test_a_failing_unit_leaves_the_ones_before_it(spark, names, tmp_path, ledger):
    yearly(tmp_path, (2021,))
    with pytest.raises(Exception):
        commits.committed_load(spark, loaders.dvf(lambda y: f"{tmp_path}/{y}.csv", 2022), ledger)
    assert mark_of(spark, names, "dvf") == "2021" and ledger.read(spark).count() == 2


def test_units_are_written_side_by_side_and_committed_in_order(spark, names, tmp_path, ledger):
    both = threading.Barrier(2, timeout=60)

    class Meeting(commits.Ledger):
        def stage(self, df, unit, mark=None, at=None):
            both.wait()     # passed by two at a time only
            return super().stage(df, unit, mark, at)

    meeting = Meeting(ledger.spec, ledger.path, ledger.commits)
    assert commits.committed_load(spark, loaders.dvf(yearly(tmp_path, range(2021, 2025)), 2024), meeting) == 8
    order = spark.table(ledger.commits).where("last_value IS NOT NULL").orderBy(TABLES[commits.COMMITS].version)
    assert [r.last_value for r in order.collect()] == ["2021", "2022", "2023", "2024"]


def test_no_unit_is_committed_after_one_that_fails(spark, names, tmp_path, ledger):
    class Failing(commits.Ledger):
        def stage(self, df, unit, mark=None, at=None):
            if df.where("annee = 2022").head(1):
                raise OSError("disk")
            return super().stage(df, unit, mark, at)

    failing = Failing(ledger.spec, ledger.path, ledger.commits)
    spec = loaders.dvf(yearly(tmp_path, range(2021, 2025)), 2024)
    with pytest.raises(OSError):
        commits.committed_load(spark, spec, failing)
    assert mark_of(spark, names, "dvf") == "2021" and ledger.read(spark).count() == 2
    assert commits.committed_load(spark, spec, ledger) == 6 and ledger.read(spark).count() == 8


def test_a_unit_is_read_from_its_newest_commit(spark, ledger):
    commits.load_batch(spark, lots(spark, range(5)), ledger, "s", 0)
    commits.load_batch(spark, lots(spark, range(5, 8)), ledger, "s", 1)
    commits.load_batch(spark, lots(spark, range(5, 8)), ledger, "s", 1)     # after a crash
    assert sorted(int(r.id_mutation) for r in ledger.read(spark).collect()) == list(range(8))
    commits.committed_reload(spark, lots(spark, [1]), ledger, "dvf")
    commits.committed_reload(spark, lots(spark, [2, 3]), ledger, "dvf")
    assert ledger.read(spark).count() == 10
    plan = ledger.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_two_streams_and_a_replay(spark, tmp_path, ledger):
    raw = lots(spark, range(40)).repartition(4)
    raw.write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        stream = streams.read_landing(spark, f"{tmp_path}/in", raw.schema, files_per_batch=1)
        commits.ingest_once(stream, ledger, lambda b: b, f"{tmp_path}/ck", "a").awaitTermination()
    assert ledger.committed(spark).count() == 4 and ledger.read(spark).count() == 40
    last = ledger.committed(spark).agg(F.max(commits.UNIT)).first()[0]
    rows = spark.read.parquet(ledger.path).where(F.col(commits.UNIT) == last).drop(commits.UNIT, commits.ATTEMPT, "_loaded_at")
    replay = spark.createDataFrame(rows.collect(), rows.schema)
    commits.load_batch(spark, replay, ledger, "a", int(last.rsplit("-", 1)[1]))
    assert ledger.read(spark).count() == 40


def test_append_mode_keeps_open_windows_back(spark, tmp_path):
    rows = [(f"2024-01-0{d} 10:00:00", 1.0) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "ts STRING, v DOUBLE").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.parquet(f"{tmp_path}/in")
    stream = streams.read_landing(spark, f"{tmp_path}/in", df.schema)
    made = streams.stream_tumbling_panel(stream, "ts", "v", [], "1 day", "1 day")
    out = streams.run_to_table(made, f"{tmp_path}/out", f"{tmp_path}/ck")
    assert out.count() == 2


def test_parse_is_one_projection(spark):
    raw = spark.createDataFrame([("1", "2022-01-01", "3,5")], "id_mutation STRING, date_mutation STRING, "
                                "valeur_fonciere STRING")
    text = parsers.parse_dvf(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_newest_version_of_every_window(spark, tmp_path):
    rows = [("2020-01-01 01:00:00", 1.0), ("2020-01-01 02:00:00", 2.0), ("2020-01-03 01:00:00", 4.0)]
    for k, (ts, v) in enumerate(rows):
        df = spark.createDataFrame([(ts, v)], "ts string, v double").selectExpr("to_timestamp(ts) AS ts", "v")
        df.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = streams.read_landing(spark, f"{tmp_path}/in/*", df.schema, files_per_batch=1)
    made = streams.stream_tumbling_panel(stream, "ts", "v", [], "1 day", "5 days")
    out = streams.run_to_versions(made, f"{tmp_path}/out", f"{tmp_path}/ck", ["debut"])
    assert sorted((r.n, r.total) for r in out.collect()) == [(1, 4.0), (2, 3.0)]


def test_scratch_removes_what_was_written(spark):
    from terrier.session import cut_lineage, scratch

    with scratch(spark):
        df = cut_lineage(spark.range(3), "scratch")
        path = df.inputFiles()[0]
        assert os.path.exists(path.removeprefix("file:").replace("///", "/")) and df.count() == 3
    assert not os.path.exists(path.removeprefix("file:").replace("///", "/"))
