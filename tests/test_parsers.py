import datetime as dt

from pyspark.sql import functions as F

from terrier.functions import numeric as nm
from terrier.functions import text as tx
from terrier.sources import parsers


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` STRING" for c in columns))


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v STRING").select(fn("v").alias("r")).first()["r"]


def test_french_numbers(spark):
    assert one(spark, "350 000,50", tx.fr_number) == 350000.5
    assert one(spark, "350 000,50", tx.fr_number) == 350000.5
    assert one(spark, "N/D", tx.fr_number) is None
    assert one(spark, "", tx.fr_number) is None
    assert one(spark, "12d", tx.to_double_or_null) is None
    assert one(spark, "NaN", tx.to_double_or_null) is None
    assert one(spark, "1e3", tx.to_double_or_null) == 1000.0


def test_whole_numbers(spark):
    assert one(spark, "3.0", tx.to_int_or_null) == 3
    assert one(spark, "trois", tx.to_int_or_null) is None
    assert one(spark, "99999999999", tx.to_int_or_null) is None


def test_department(spark):
    for code, dept in (("75056", "75"), ("97100", "971"), ("98800", "988"), ("2A004", "2A"), ("", "")):
        assert one(spark, code, tx.dept_from_commune) == dept


def test_quarter(spark):
    for text, want in (("2024-T3", (2024, 3)), ("bad", (None, None)), (None, (None, None))):
        year, quarter = tx.split_quarter("v")
        row = spark.createDataFrame([(text,)], "v STRING").select(
            year.alias("y"), quarter.alias("q")).first()
        assert (row.y, row.q) == want


def test_round_half_even(spark):
    rows = [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-0.5, 0.0), (2.675, 3.0)]
    got = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE").select(
        nm.round_he("x", 0).alias("r"), "y").collect()
    assert all(abs(r.r) == r.y for r in got)


def test_guarded_ratio(spark):
    row = spark.createDataFrame([(1, 0), (1, 3)], "a INT, b INT").select(
        nm.rate("a", "b", 1, 100.0).alias("r")).collect()
    assert [r.r for r in row] == [None, 33.3]


def test_dvf(spark):
    columns = ["id_mutation", "date_mutation", "valeur_fonciere", "code_commune", "type_local",
               "surface_reelle_bati", "nombre_pieces_principales", "inconnue"]
    df = parsers.parse_dvf(frame(spark, [
        ("2022-1234", "2022-06-15", "350 000,50", "75056", None, "", "3", "x"),
        ("2023-5678", "not-a-date", "280000", "69123", "Maison", "95.0", "x", "y"),
    ], columns))
    assert "inconnue" not in df.columns
    a, b = df.orderBy("id_mutation").collect()
    assert a.valeur_fonciere == 350000.5 and a.annee == 2022 and a.type_local == ""
    assert a.surface_reelle_bati is None and a.nombre_pieces_principales == 3
    assert b.date_mutation is None and b.annee is None and b.nombre_pieces_principales is None
    assert a.date_mutation == dt.date(2022, 6, 15)


def test_dpe(spark):
    row = parsers.parse_dpe(frame(
        spark, [("2023-75-001", "2023-04-12", "97105", "C", "145.2", "bad")],
        ["numero_dpe", "date_etablissement_dpe", "code_insee_ban", "etiquette_dpe",
         "conso_5_usages_par_m2_ep", "emission_ges_5_usages_par_m2"])).first()
    assert row.code_departement == "971" and row.annee == 2023
    assert row.consommation_energie_primaire == 145.2 and row.emission_ges is None


def test_sitadel_since(spark):
    df = frame(spark, [
        ("2024", "03", "01001", "T", "5"), ("2024", "04", "01001", "T", "6"),
        ("2025", "01", "97411", None, "7"), ("NC", "01", "01001", "T", "8"),
    ], ["ANNEE", "MOIS", "CODE_INSEE", "TYPE_LGT", "LOG_AUT"])
    assert parsers.parse_sitadel(df).count() == 4
    got = parsers.parse_sitadel(df, (2024, 3)).orderBy("annee").collect()
    assert [r.nb_logements_autorises for r in got] == [6, 7]
    assert got[1].type_logement == "" and got[1].code_departement == "974"


def test_ecln_since(spark):
    df = frame(spark, [("2024-T3", "75", "120"), ("2024-T4", "75", ""), ("bad", "75", "1")],
               ["TRIMESTRE", "DEP_CODE", "MEV"])
    got = parsers.parse_ecln(df, "2024-T3").collect()
    assert {(r.annee, r.trimestre, r.nb_mises_en_vente) for r in got} == {
        (2024, 4, None), (None, None, 1)}


def test_eptb_outer(spark):
    land = frame(spark, [("2024", "11", "IdF", "150")], ["ANNEE", "ZONE_CODE", "ZONE_LIBELLE", "NB_TERRAINS"])
    houses = frame(spark, [("2024", "76", "Occitanie", "120")],
                   ["ANNEE", "ZONE_CODE", "ZONE_LIBELLE", "NB_MAISONS"])
    got = {r.zone_code: (r.nb_terrains, r.nb_maisons) for r in parsers.parse_eptb(land, houses).collect()}
    assert got == {"11": (150, None), "76": (None, 120)}


def test_rpls_insee_macro(spark):
    row = parsers.parse_rpls(frame(spark, [("75056", "NC", "48.5", "2")],
                                   ["DEPCOM", "CONSTRUCT", "SURFHAB", "NBPIECE"]), 2024).first()
    assert row.annee == 2024 and row.annee_construction is None and row.nb_pieces == 2
    row = parsers.parse_insee(frame(spark, [("01001", "21350,5", "ND", "820")], [
        "code_commune", "revenu_disponible_median", "taux_pauvrete", "population_municipale"])).first()
    assert (row.revenu_disponible_median, row.taux_pauvrete, row.population_municipale) == (
        21350.5, None, 820)
    rates = frame(spark, [("2024-06-01", "3,75"), ("2024-12-01", "3,20"), ("hier", "1")],
                  ["date", "taux_credit_immobilier"])
    got = parsers.parse_macro(rates, "2024-11").collect()
    assert [(r.annee, r.mois, r.taux_credit_immobilier) for r in got] == [(2024, 12, 3.2)]
    assert parsers.parse_macro(rates).count() == 2


def test_label_of(spark):
    df = spark.createDataFrame([("a",), ("z",)], "v STRING")
    assert [r[0] for r in df.select(tx.label_of(F.col("v"), {"a": "A!"})).collect()] == ["A!", "z"]


def test_csv_keeps_quotes_separators_and_line_breaks(spark, tmp_path):
    from terrier.sources.readers import read_csv

    (tmp_path / "a.csv").write_text('id,nom\n1,"dit ""le Clos"" nord, bis"\n2,"deux\nlignes"\n3,NA\n')
    rows = {r["id"]: r["nom"] for r in read_csv(spark, str(tmp_path / "a.csv"), ",").collect()}
    assert rows == {"1": 'dit "le Clos" nord, bis', "2": "deux\nlignes", "3": None}


def test_zone_without_a_label_keeps_both_halves(spark):
    from terrier.sources.parsers import HOUSE_NAMES, LAND_NAMES, ZONE_NAMES, parse_eptb

    zone = {v: k for k, v in ZONE_NAMES.items()}
    def side(names):
        back = {v: k for k, v in names.items()}
        values = {back.get(c, zone.get(c)): v for c, v in {"annee": "2020", "zone_code": "7", "zone_libelle": None}.items() if back.get(c, zone.get(c))}
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"`{c}` string" for c in values))
    assert parse_eptb(side(LAND_NAMES), side(HOUSE_NAMES)).count() == 1
