"""Aggregates, windows, orders, samples, scalar functions and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrier.catalogue.marts import Warehouse, features_dense, panel_dense, panel_mean
from terrier.catalogue.registry import query
from terrier.catalogue.roles import quantile, ratio, rnd, rnd_once, table
from terrier.catalogue.sql import (
    avg, change_columns, compose, lag_columns, pct, roll_columns,
)
from terrier.functions import numeric as nm
from terrier.functions import text as tx
from terrier.operators import aggregates as ag
from terrier.operators import quality as qa
from terrier.operators import rows, sampling
from terrier.operators import windows as wn
from terrier.operators.quantiles import approx_quantiles, exact_quantiles, profile_columns
from terrier.plans import warehouse
from terrier.session import cut_lineage

# --- aggregates ------------------------------------------------------------------------


@query("A01_count", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def count(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(ag.count_rows("n"))


@query("A02_count_if", """
SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS n_a,
  count(*) FILTER (l_returnflag = 'N') AS n_n, count(*) FILTER (l_returnflag = 'R') AS n_r,
  count(*) FILTER (l_returnflag IN ('A', 'R')) AS n_ar FROM lineitem GROUP BY 1""")
def count_if(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        *ag.count_by_value("l_returnflag", {"A": "n_a", "N": "n_n", "R": "n_r"}),
        ag.count_where(F.col("l_returnflag").isin("A", "R"), "n_ar"))


@query("A03_share", f"""
SELECT l_suppkey, {pct("l_returnflag = 'A'")} AS pct_a,
  {pct("l_returnflag IN ('N', 'R')", 2)} AS pct_nr FROM lineitem GROUP BY 1""")
def share(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        nm.share(F.col("l_returnflag") == "A").alias("pct_a"),
        nm.share(F.col("l_returnflag").isin("N", "R"), 2).alias("pct_nr"))


@query("A04_sum", f"""
SELECT o_custkey, sum(l_linenumber)::BIGINT AS lignes, {rnd('sum(l_extendedprice)', 2)} AS valeur
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def total(spark, sf):
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).groupBy("o_custkey").agg(
        nm.total("l_linenumber").alias("lignes"), nm.total("l_extendedprice", 2).alias("valeur"))


@query("A05_guarded_ratio", f"""
SELECT o_custkey, {ratio("count(*) FILTER (o_orderstatus = 'F')",
                         "count(*) FILTER (o_orderstatus = 'P')", 1, 100)} AS taux
FROM orders GROUP BY 1""")
def guarded_ratio(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        nm.rate(F.count_if(status == "F"), F.count_if(status == "P"), 1, 100.0).alias("taux"))


@query("A06_avg", f"""
SELECT l_partkey, {avg('l_extendedprice', 1)} AS prix, {avg('l_quantity', 1)} AS quantite,
  {avg('l_extendedprice / l_quantity', 0)} AS prix_unite FROM lineitem GROUP BY 1""")
def average(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        nm.mean("l_extendedprice", 1).alias("prix"), nm.mean("l_quantity", 1).alias("quantite"),
        nm.mean(F.col("l_extendedprice") / F.col("l_quantity"), 0).alias("prix_unite"))


@query("A07_min_max", f"""
SELECT l_suppkey, {rnd_once('min(l_extendedprice)', 0)} AS mini,
  {rnd_once('max(l_extendedprice)', 0)} AS maxi, min(year(l_shipdate))::INTEGER AS annee_min,
  max(year(l_shipdate))::INTEGER AS annee_max FROM lineitem GROUP BY 1""")
def min_max(spark, sf):
    year = F.year("l_shipdate")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        nm.round_he(F.min("l_extendedprice"), 0).alias("mini"),
        nm.round_he(F.max("l_extendedprice"), 0).alias("maxi"),
        F.min(year).alias("annee_min"), F.max(year).alias("annee_max"))


_PROBS = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


@query("A08_quantiles", "SELECT l_suppkey, " + ", ".join(
    f"{quantile('l_extendedprice / l_quantity', q, 2)} AS {n}" for n, q in _PROBS.items())
    + " FROM lineitem GROUP BY 1")
def quantiles(spark, sf):
    priced = table(spark, sf, "lineitem").select(
        "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("prix"))
    return exact_quantiles(priced, ["l_suppkey"], "prix", _PROBS, 2)


@query("A08_quantiles_one_group", "SELECT " + ", ".join(
    f"{quantile('l_extendedprice', q, 2)} AS {n}" for n, q in _PROBS.items()) + " FROM lineitem")
def quantiles_all(spark, sf):
    return exact_quantiles(table(spark, sf, "lineitem"), [], "l_extendedprice", _PROBS, 2)


@query("A08_quantiles_approx")
def quantiles_approx(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        *approx_quantiles("l_extendedprice", _PROBS, 2))


@query("A09_any_value", """
SELECT o_custkey, max(c_name) AS nom, arg_max(o_orderpriority, o_orderkey) AS derniere
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def any_value(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    named = orders.join(customer, orders.o_custkey == customer.c_custkey)
    names = ag.constants(named.withColumnRenamed("c_name", "nom"), "o_custkey", ["nom"])
    last = orders.groupBy("o_custkey").agg(ag.latest_of("o_orderpriority", "o_orderkey", "derniere"))
    return names.join(last, "o_custkey")


@query("A10_count_distinct", """
SELECT year(o_orderdate)::INTEGER AS annee, count(DISTINCT o_custkey) AS n_communes FROM orders
GROUP BY 1""")
def count_distinct(spark, sf):
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("annee")).agg(
        F.countDistinct("o_custkey").alias("n_communes"))


_PROFILED = ["prix_m2_moy", "nb_transactions", "evol_12m_pct"]


@query("A11_profile", compose(" UNION ALL ".join(
    f"SELECT '{c}' AS colonne, count({c}) AS n, {avg(c, 4)} AS moyenne, "
    f"{rnd(f'stddev_samp({c})', 4)} AS ecart_type, {rnd_once(f'min({c})', 4)} AS mini, "
    f"{rnd_once(f'max({c})', 4)} AS maxi, "
    + ", ".join(f"{quantile(c, q, 4)} AS {n}" for n, q in
                (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    + " FROM features_dense" for c in _PROFILED)))
def profile(spark, sf):
    return profile_columns(cut_lineage(features_dense(spark, sf), "features"), _PROFILED)


# --- windows --------------------------------------------------------------------------------

_ID = "code_commune, annee, mois"


@query("W01_lags", compose(
    f"SELECT {_ID}, {lag_columns()} FROM panel_dense "
    "WINDOW w AS (PARTITION BY code_commune ORDER BY annee, mois)"))
def lags(spark, sf):
    w = wn.series("code_commune", "annee", "mois")
    made = wn.lags("prix_m2_moy", w, {k: f"prix_m2_lag_{k}m" for k in (1, 3, 6, 12)})
    return panel_dense(spark, sf).withColumns(made).select("code_commune", "annee", "mois", *made)


@query("W01_calendar_lags", compose("""
SELECT p.code_commune, p.annee, p.mois, a.prix AS prix_lag_1m, b.prix AS prix_lag_12m
FROM panel_sparse p
LEFT JOIN panel_sparse a ON a.code_commune = p.code_commune
  AND a.annee * 12 + a.mois = p.annee * 12 + p.mois - 1
LEFT JOIN panel_sparse b ON b.code_commune = p.code_commune
  AND b.annee * 12 + b.mois = p.annee * 12 + p.mois - 12"""))
def calendar_lags(spark, sf):
    panel = panel_sparse(spark, sf).withColumn("jour", F.make_date("annee", "mois", F.lit(1)))
    made = wn.calendar_lags("prix", "jour", "code_commune", {1: "prix_lag_1m", 12: "prix_lag_12m"})
    return panel.withColumns(made).select("code_commune", "annee", "mois", *made)


@query("W02_rolling_means", compose(f"SELECT {_ID}, {roll_columns()} FROM panel_dense"))
def rolling(spark, sf):
    w = wn.series("code_commune", "annee", "mois")
    made = wn.rolling_means("prix_m2_moy", w, {k: f"prix_m2_roll{k}m" for k in (3, 6, 12)})
    return panel_dense(spark, sf).withColumns(made).select("code_commune", "annee", "mois", *made)


@query("W03_pct_change", compose(
    f"SELECT {_ID}, {change_columns()} FROM panel_dense "
    "WINDOW w AS (PARTITION BY code_commune ORDER BY annee, mois)"))
def pct_change(spark, sf):
    w = wn.series("code_commune", "annee", "mois")
    made = wn.pct_changes("prix_m2_moy", w, {k: f"evol_{k}m_pct" for k in (1, 12)})
    return panel_dense(spark, sf).withColumns(made).select("code_commune", "annee", "mois", *made)


@query("W04_named_window", compose("SELECT * FROM features_dense"))
def named_window(spark, sf):
    return features_dense(spark, sf)


def panel_sparse(spark, sf):
    """Order values by customer and month; months without an order are absent."""
    return table(spark, sf, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("code_commune"),
        F.year("o_orderdate").alias("annee"), F.month("o_orderdate").alias("mois"),
    ).agg(
        nm.mean("o_totalprice", 2).alias("prix"), ag.count_rows("nb"),
        nm.mean(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), 2).alias("prix_f"),
    )


@query("W05_fill_series", compose("""
SELECT code_commune, annee, mois,
  coalesce(last_value(prix_f IGNORE NULLS) OVER w, first_value(prix_f IGNORE NULLS) OVER v, 0)
    ::DOUBLE AS prix_f
FROM panel_sparse WINDOW
  w AS (PARTITION BY code_commune ORDER BY annee, mois
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  v AS (PARTITION BY code_commune ORDER BY annee, mois
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""))
def fill(spark, sf):
    panel = panel_sparse(spark, sf).select("code_commune", "annee", "mois", "prix_f")
    return wn.fill_series(panel, "code_commune", ["annee", "mois"], ["prix_f"])


@query("W06_sliding_sequences", compose("""
SELECT code_commune, annee, mois, array_to_string(x, '|') AS x, y1, y2, y3 FROM (
  SELECT code_commune, annee, mois, list(round(prix_m2_moy * 100)::BIGINT) OVER (
      PARTITION BY code_commune ORDER BY annee, mois ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS x,
    prix_m2_moy AS y1, lead(prix_m2_moy, 1) OVER w AS y2, lead(prix_m2_moy, 2) OVER w AS y3
  FROM panel_dense
  WINDOW w AS (PARTITION BY code_commune ORDER BY annee, mois))
WHERE len(x) = 12 AND y3 IS NOT NULL"""))
def sequences(spark, sf):
    """Prices to the cent: the windows hold them whole, the text lists them in cents."""
    made = wn.sliding_sequences(
        panel_mean(spark, sf), "code_commune", ["annee", "mois"], ["prix_m2_moy"], {"y": "prix_m2_moy"})
    cents = F.transform(F.flatten("x"), lambda v: F.rint(v * 100).cast("bigint").cast("string"))
    return made.select(
        "code_commune", "annee", "mois", F.array_join(cents, "|").alias("x"),
        *[F.element_at("y", i).alias(f"y{i}") for i in (1, 2, 3)])


# --- orders, sets, samples -------------------------------------------------------------------

@query("O01_multi_key_order", compose("SELECT * FROM features_dense"))
def ordered(spark, sf):
    return features_dense(spark, sf).orderBy("annee", "mois", "code_commune")


_NAIVE = "prix_m2_lag_1m"


@query("O02_top_k_groups", compose(f"""
SELECT code_departement, {rnd(f'avg(abs({_NAIVE} - prix_m2_med))', 2)} AS mae, count(*) AS n
FROM features_dense WHERE {_NAIVE} IS NOT NULL GROUP BY 1
ORDER BY mae DESC, code_departement LIMIT 10"""))
def top_groups(spark, sf):
    known = features_dense(spark, sf).where(F.col(_NAIVE).isNotNull())
    errors = known.groupBy("code_departement").agg(
        nm.mean(F.abs(F.col(_NAIVE) - F.col("prix_m2_med")), 2).alias("mae"), ag.count_rows("n"))
    return rows.top_k(errors, [F.desc("mae"), F.asc("code_departement")], 10)


@query("O04_union_all", """
SELECT o_custkey AS cle, 'commande' AS page FROM orders
UNION ALL SELECT c_custkey, 'client' FROM customer""")
def union_all(spark, sf):
    return rows.union_pages([
        table(spark, sf, "orders").select(
            F.col("o_custkey").alias("cle"), F.lit("commande").alias("page")),
        table(spark, sf, "customer").select(
            F.col("c_custkey").alias("cle"), F.lit("client").alias("page")),
    ])


@query("O05_distinct_values", "SELECT DISTINCT year(l_shipdate)::INTEGER AS annee FROM lineitem")
def distinct(spark, sf):
    years = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("annee"))
    return rows.distinct_values(years, "annee")


@query("R01_hash_sample", """
SELECT o_custkey, o_orderkey FROM orders
WHERE ('0x' || substr(md5(o_custkey || ',' || o_orderkey), 1, 8))::BIGINT % 20 = 0""")
def hash_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return sampling.hash_sample(orders, ["o_custkey", "o_orderkey"], 20)


@query("R01_hash_sample_fast")
def hash_sample_fast(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return sampling.hash_sample(orders, ["o_custkey", "o_orderkey"], 20, portable=False)


@query("R02_random_split", """
SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey || ',42'), 1, 8))::BIGINT % 10000 < 8000
  THEN 'train' ELSE 'test' END AS part FROM orders""")
def random_split(spark, sf):
    train, test = sampling.random_split(table(spark, sf, "orders"), ["o_orderkey"], 0.8, 42)
    return rows.union_pages([
        part.select("o_orderkey", F.lit(name).alias("part"))
        for part, name in ((train, "train"), (test, "test"))])


@query("R03_random_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5(o_orderkey || ',42'), o_orderkey LIMIT 5000""")
def random_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.random_sample(orders, ["o_orderkey"], 5000, 42)


# --- scalar functions ------------------------------------------------------------------------

@query("F01_round_half_even", f"""
SELECT l_orderkey, l_linenumber, {rnd_once('l_extendedprice / l_quantity', 0)} AS r0,
  {rnd_once('l_extendedprice / l_quantity', 1)} AS r1,
  {rnd_once('l_extendedprice / l_quantity', 2)} AS r2,
  {rnd_once('l_quantity / 8', 2)} AS tie FROM lineitem""")
def rounding(spark, sf):
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[nm.round_he(price, d).alias(f"r{d}") for d in (0, 1, 2)],
        nm.round_he(F.col("l_quantity") / 8, 2).alias("tie"))


@query("F02_nullif", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS statut, "
       "nullif((o_orderkey % 7)::BIGINT, 0) AS reste FROM orders")
def nullif(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("statut"),
        F.nullif(F.col("o_orderkey") % 7, F.lit(0).cast("bigint")).alias("reste"))


@query("F03_month_of_date", "SELECT o_orderkey, month(o_orderdate)::INTEGER AS mois FROM orders")
def month(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.month("o_orderdate").alias("mois"))


@query("F04_make_date", "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS date_mois FROM orders")
def make_date(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("date_mois"))


@query("F05_cyclic_encoding", f"""
SELECT month(l_shipdate)::INTEGER AS mois, count(*) AS n,
  {rnd_once('sin(2 * pi() * month(l_shipdate) / 12)', 6)} AS mois_sin,
  {rnd_once('cos(2 * pi() * month(l_shipdate) / 12)', 6)} AS mois_cos FROM lineitem GROUP BY ALL""")
def cyclic(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy(F.month("l_shipdate").alias("mois")).agg(
        ag.count_rows("n"))
    sine, cosine = nm.cyclic("mois", 12)
    return counted.withColumns({"mois_sin": sine, "mois_cos": cosine})


@query("F06_hash_bucket", """
SELECT ('0x' || substr(md5(o_custkey::VARCHAR), 1, 8))::BIGINT % 20 AS seau, count(*) AS n
FROM orders GROUP BY 1""")
def bucket(spark, sf):
    return table(spark, sf, "orders").groupBy(
        sampling.hash_bucket(["o_custkey"], 20).alias("seau")).agg(ag.count_rows("n"))


@query("F07_predicates", """
SELECT o_orderkey, o_orderstatus IN ('F', 'O') AS dans, nullif(o_orderstatus, 'P') IS NULL AS vide,
  o_totalprice > 100000 AS grand FROM orders""")
def predicates(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey", status.isin("F", "O").alias("dans"),
        F.nullif(status, F.lit("P")).isNull().alias("vide"),
        (F.col("o_totalprice") > 100000).alias("grand"))


@query("F08_string_prefix", """
SELECT c_custkey, substr(c_name, 10) AS fin, c_mktsegment LIKE 'B%' AS debut FROM customer""")
def prefix(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.expr("substring(c_name, 10)").alias("fin"),
        F.col("c_mktsegment").startswith("B").alias("debut"))


@query("F09_split_text", """
SELECT o_orderkey, split_part(o_orderpriority, '-', 1)::INTEGER AS rang,
  split_part(o_orderpriority, '-', 2) AS nom FROM orders""")
def split_text(spark, sf):
    parts = F.split("o_orderpriority", "-", 2)
    return table(spark, sf, "orders").select(
        "o_orderkey", parts[0].try_cast("int").alias("rang"), parts[1].alias("nom"))


@query("F10_translate", "SELECT p_partkey, replace(replace(p_name, ' ', ''), 'e', '.') AS nom FROM part")
def translate(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.translate("p_name", "e ", ".").alias("nom"))


@query("F11_date_arithmetic", """
SELECT o_orderkey, (o_orderdate::DATE + 1)::DATE AS lendemain,
  strftime(o_orderdate, '%Y-%m') AS mois FROM orders""")
def date_arithmetic(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_add(F.to_date("o_orderdate"), 1).alias("lendemain"),
        F.date_format("o_orderdate", "yyyy-MM").alias("mois"))


@query("F12_period_key", """
SELECT (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS periode, count(*) AS n
FROM orders GROUP BY 1""")
def period_key(spark, sf):
    key = nm.period_key(F.year("o_orderdate"), F.month("o_orderdate"))
    return table(spark, sf, "orders").groupBy(key.alias("periode")).agg(ag.count_rows("n"))


@query("F13_to_json", """
SELECT c_custkey, '{"lookback":12,"nom":"' || c_name || '"}' AS params FROM customer""")
def to_json(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.to_json(F.struct(F.lit(12).alias("lookback"), F.col("c_name").alias("nom"))).alias("params"))


@query("F14_json_navigation", """
SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events""")
def json_navigation(spark, sf):
    parsed = F.from_json("props", "k BIGINT")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query("F15_error_functions", f"""
SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS ecart,
  power(l_quantity - 25, 2) AS carre, {rnd('sqrt(l_extendedprice)', 4)} AS racine,
  least(greatest(l_extendedprice, 0), 1000) AS borne FROM lineitem""")
def error_functions(spark, sf):
    gap = F.col("l_quantity") - 25
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.abs(gap).alias("ecart"), F.pow(gap, F.lit(2)).alias("carre"),
        nm.settle(F.sqrt("l_extendedprice"), 4).alias("racine"),
        nm.clip("l_extendedprice", 0, 1000).alias("borne"))


@query("F16_label_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fermée' WHEN 'O' THEN 'ouverte'
  ELSE o_orderstatus END AS libelle FROM orders""")
def label_map(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        tx.label_of("o_orderstatus", {"F": "fermée", "O": "ouverte"}).alias("libelle"))


# --- data checks -------------------------------------------------------------------------------

def _null_sql(source: str, name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'not_null' AS \"check\", '{name}' AS \"table\", '{c}' AS \"column\", "
        f"count(*) FILTER ({c} IS NULL) AS failures FROM {source}" for c in columns)


def _repeat_sql(source: str, name: str, keys: list[str], check: str) -> str:
    known = f"WHERE {keys[0]} IS NOT NULL" if check == "unique" else ""
    return (
        f"SELECT '{check}' AS \"check\", '{name}' AS \"table\", '{','.join(keys)}' AS \"column\", "
        f"count(*) AS failures FROM (SELECT 1 FROM {source} {known} GROUP BY {', '.join(keys)} "
        "HAVING count(*) > 1)")


def _accepted_sql(source: str, name: str, column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return (
        f"SELECT 'accepted_values' AS \"check\", '{name}' AS \"table\", '{column}' AS \"column\", "
        f"count(*) FILTER ({column} NOT IN ({listed})) AS failures FROM {source}")


@query("Q01_not_null", compose(_null_sql(
    "stg_dvf", "stg_dvf", ["date_mutation", "type_local", "surface_terrain"])))
def not_null(spark, sf):
    return qa.not_null(
        Warehouse(spark, sf).stg("dvf"), "stg_dvf", ["date_mutation", "type_local", "surface_terrain"])


@query("Q02_unique", compose(_repeat_sql("stg_dvf", "stg_dvf", ["id_mutation"], "unique")))
def unique(spark, sf):
    return qa.unique(Warehouse(spark, sf).stg("dvf"), "stg_dvf", "id_mutation")


@query("Q03_accepted_values", compose(_accepted_sql(
    "stg_dpe", "stg_dpe", "etiquette_dpe", ["A", "C", "F"])))
def accepted(spark, sf):
    return qa.accepted_values(
        Warehouse(spark, sf).stg("dpe"), "stg_dpe", "etiquette_dpe", ["A", "C", "F"])


@query("Q04_unique_grain", compose(_repeat_sql(
    "fct_dpe_commune", "fct_dpe_commune", ["annee", "code_commune"], "unique_grain")
    + " UNION ALL " + _repeat_sql(
        "fct_transactions", "fct_transactions", ["annee", "code_commune"], "unique_grain")))
def unique_grain(spark, sf):
    w = Warehouse(spark, sf)
    keys = ["annee", "code_commune"]
    return qa.quality_report([
        qa.unique_grain(w.dpe, "fct_dpe_commune", keys),
        qa.unique_grain(w.transactions, "fct_transactions", keys)])


_CHECKED = ["stg_dvf", "stg_dpe", "fct_transactions", "dim_commune", "dim_departement",
            "fct_construction", "fct_marche_neuf", "fct_logement_social", "fct_dpe_commune",
            "int_ecln_dept_annee"]


def _report_sql() -> str:
    parts = []
    for name in _CHECKED:
        rules = qa.DECLARED[name]
        parts.append(_null_sql(name, name, rules["not_null"]))
        parts += [_repeat_sql(name, name, [c], "unique") for c in rules.get("unique", [])]
        parts += [_accepted_sql(name, name, c, v) for c, v in rules.get("accepted", {}).items()]
        parts += [_repeat_sql(name, name, g, "unique_grain") for g in rules.get("grain", [])]
    return compose(" UNION ALL ".join(parts))


@query("Q05_quality_report", _report_sql())
def quality_report(spark, sf):
    w = Warehouse(spark, sf, landed=True, staged=True)
    made = {
        "stg_dvf": w.stg("dvf"), "stg_dpe": w.stg("dpe"), "fct_transactions": w.transactions,
        "dim_commune": warehouse.dim_commune(w.stg("dvf"), w.stg("rpls")),
        "dim_departement": w.departements, "fct_construction": w.construction,
        "fct_marche_neuf": w.marche_neuf, "fct_logement_social": w.social,
        "fct_dpe_commune": w.dpe, "int_ecln_dept_annee": w.ecln_year,
    }
    return qa.quality_report([qa.declared_checks(made[name], name) for name in _CHECKED])
