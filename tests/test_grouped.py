"""Groups ranked whole, and warehouses that lie by year and commune."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from terrier.catalogue import roles
from terrier.catalogue.marts import Warehouse
from terrier.operators.quantiles import ROW, aggregate_with_quantiles, largest_cell
from terrier.plans import features
from terrier.sources import sinks

WANTED = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q1": 1.0}


def _rows(spark):
    values = [
        ("a", 1, 3.0), ("a", 1, 1.0), ("a", 1, 1.0), ("a", 1, None), ("a", 2, -0.0), (None, 1, 5.0),
        (None, 1, 7.0), ("b", None, math.inf), ("b", None, 2.0), ("c", 1, None), ("d", 1, math.nan), ("d", 1, 4.0)]
    return spark.createDataFrame(values, "k string, m int, v double")


def _exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line for line in text.splitlines())


def test_groups_ranked_whole_equal_bands(spark):
    df, parts = _rows(spark), {"n": F.count(ROW), "mean": F.avg("v")}
    banded = aggregate_with_quantiles(df, ["k", "m"], parts, "v", WANTED, 3)
    whole = aggregate_with_quantiles(df, ["k", "m"], parts, "v", WANTED, 3, whole=100)
    key = lambda r: str(r)
    assert sorted(map(str, whole.collect()), key=key) == sorted(map(str, banded.collect()), key=key)


def test_groups_ranked_whole_take_one_exchange(spark):
    df = _rows(spark)
    assert _exchanges(aggregate_with_quantiles(df, ["k", "m"], {"n": F.count(ROW)}, "v", WANTED, whole=100)) == 1


def test_large_groups_stay_banded(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    assert 250 <= largest_cell(df, ["k"]) <= 500
    plans = [aggregate_with_quantiles(df, ["k"], {"n": F.count(ROW)}, "v", WANTED, whole=w) for w in (100, 500)]
    assert _exchanges(plans[0]) > _exchanges(plans[1]) == 1
    assert sorted(plans[0].collect()) == sorted(plans[1].collect())
    assert largest_cell(df.limit(0), ["k"]) == 0


def test_panel_takes_one_exchange(spark):
    day = dt.date(2020, 1, 5)
    rows = [(2020, day, "1", "9", "Maison", 1000.0 + i, 50.0, 3) for i in range(5)]
    tx = spark.createDataFrame(
        rows, "annee int, date_mutation date, code_commune string, code_departement string, type_local string, "
        "prix_m2 double, surface_reelle_bati double, nombre_pieces_principales int")
    panel = features.panel_commune_mois(tx)
    assert _exchanges(panel) == 1
    assert [(r.nb_transactions, r.prix_m2_med, r.pct_maison) for r in panel.collect()] == [(5, 1002.0, 100.0)]


@pytest.fixture(scope="module")
def landed(spark, data):
    return Warehouse(spark, data, landed=True)


@pytest.mark.parametrize("name", ["construction", "transactions"])
def test_facts_of_clustered_tables_have_no_exchange(landed, name):
    assert _exchanges(getattr(landed, name)) == 0


def test_clustered_warehouse_has_the_same_rows(spark, data, landed):
    plain = Warehouse(spark, data)
    for name in ("construction", "transactions", "dpe", "social"):
        a, b = getattr(plain, name), getattr(landed, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_permit_totals_stay_beside_their_kinds(spark):
    days = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]
    items = spark.createDataFrame(
        [(days[0], "1", "9", "A", "F", 2.0), (days[1], "1", "9", "A", "O", 3.0), (days[2], "1", "9", None, "F", 4.0)],
        "l_shipdate timestamp_ntz, code_commune string, code_departement string, l_returnflag string, "
        "l_linestatus string, l_quantity double").withColumn("annee", F.year("l_shipdate"))
    got = roles.raw_sitadel(spark, "", items).select(
        "type_logement", "nb_logements_autorises", "nb_logements_commences", "surface_autorisee", "surface_commencee")
    assert {tuple(r) for r in got.collect()} == {
        ("A", 2, 1, 5.0, 2.0), (None, 1, 1, 4.0, 4.0), ("Tous Logements", 3, 2, 9.0, 6.0)}


def test_bucketed_without_another_shuffle(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id").repartition(8, "k")
    made = sinks.bucketed(df, "lying_by_k", ["k"], 8, sort=[], location=str(tmp_path / "t"), spread=False)
    grouped = made.groupBy("k", "id").count()
    assert grouped.count() == 100 and _exchanges(grouped) == 0
