"""Staging views, facts, dimensions, reports and the feature panel."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.catalogue import roles
from terrier.catalogue.registry import query
from terrier.catalogue.sql import compose, select
from terrier.functions.numeric import settle
from terrier.plans import features, staging, warehouse
from terrier.session import cut_lineage, fresh_path
from terrier.sources import sinks


class Warehouse:
    """Tables of the warehouse over one data folder, each built once.

    Views are lazy. ``table`` gives the transactions as a written table, for the
    reports that read them more than once. With ``landed`` the placed line items,
    from which three raw tables derive, the new-housing rows and the small context
    tables (communes or departments by year) are written once as well, so that Spark
    knows their size when it plans the joins; without ``lots`` the placed items have no
    columns that only the transactions read. With ``staged`` every staging view is
    written too, for queries that read all of them several times.

    With ``clustered`` (as landed warehouses are) the placed items and the certificates are
    shuffled once by year and commune: versions, facts, contexts and the monthly panel group
    by these and more, and follow without another exchange. A commune's year is then one
    task's.
    """

    def __init__(
        self, spark: SparkSession, sf: str, landed: bool = False, staged: bool = False,
        lots: bool = True, clustered: bool | None = None,
    ):
        self.spark, self.sf, self.landed, self.staged, self.lots = spark, sf, landed, staged, lots
        self.clustered = landed if clustered is None else clustered
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def raw(self, name: str) -> DataFrame:
        make = getattr(roles, f"raw_{name}")
        if (self.landed or self.clustered) and name in ("dvf", "sitadel", "rpls"):
            return self._once(f"raw_{name}", lambda: make(self.spark, self.sf, self.placed))
        if self.clustered and name == "dpe":
            return self._once("raw_dpe", lambda: make(self.spark, self.sf).repartition(*warehouse.COMMUNE_YEAR))
        return self._once(f"raw_{name}", lambda: make(self.spark, self.sf))

    @property
    def placed(self):
        def make() -> DataFrame:
            items = roles.placed_items(self.spark, self.sf, self.lots)
            if self.clustered:
                items = items.repartition(*warehouse.COMMUNE_YEAR)
            if not self.landed:
                return items
            return self._by_commune(items, "placed") if self.clustered else cut_lineage(items, "placed")

        return self._once("placed", make)

    def _by_commune(self, df: DataFrame, label: str) -> DataFrame:
        """A written table that lies by year and commune, as ``df`` does already."""
        name, parts = f"{label}_{uuid.uuid4().hex[:12]}", self.spark.conf.get("spark.sql.shuffle.partitions")
        return sinks.bucketed(
            df, name, warehouse.COMMUNE_YEAR, int(parts), sort=[], location=fresh_path(self.spark, name),
            spread=False)

    def stg(self, name: str) -> DataFrame:
        make = getattr(staging, f"stg_{name}")
        if self.staged and self.clustered and name in ("dvf", "dpe", "sitadel"):
            return self._once(f"stg_{name}", lambda: self._by_commune(make(self.raw(name)), f"stg_{name}"))
        if name == "ecln" or self.staged:
            return self._once(f"stg_{name}", lambda: self._land(make(self.raw(name)), f"stg_{name}"))
        return self._once(f"stg_{name}", lambda: make(self.raw(name)))

    def _land(self, df: DataFrame, label: str) -> DataFrame:
        return cut_lineage(df, label) if self.landed else df

    @property
    def transactions(self):
        return self._once("tx", lambda: warehouse.fct_transactions(self.stg("dvf")))

    @property
    def table(self):
        return self._once("tx_table", lambda: cut_lineage(self.transactions, "transactions"))

    def sold(self, *columns: str) -> DataFrame:
        """Some columns of the transactions as a written table: reports read it twice."""
        if "tx_table" in self._made:
            return self.table.select(*columns)
        by_commune = self.clustered and {*warehouse.COMMUNE_YEAR} <= {*columns}
        land = self._by_commune if by_commune else cut_lineage
        return self._once(f"sold_{columns}", lambda: land(self.transactions.select(*columns), "sold"))

    @property
    def dpe(self):
        return self._once("dpe", lambda: warehouse.fct_dpe_commune(self.stg("dpe")))

    @property
    def construction(self):
        return self._once("permits", lambda: warehouse.fct_construction(self.stg("sitadel")))

    @property
    def social(self):
        return self._once("social", lambda: warehouse.fct_logement_social(self.stg("rpls")))

    @property
    def marche_neuf(self):
        return self._once("new", lambda: warehouse.fct_marche_neuf(self.stg("ecln")))

    @property
    def ecln_year(self):
        return self._once("ecln_year", lambda: self._land(
            warehouse.int_ecln_dept_annee(self.marche_neuf), "ecln_year"))

    @property
    def departements(self):
        return self._once("dept", lambda: warehouse.dim_departement(self.stg("ecln")))

    @property
    def communes(self):
        return self._once("context", lambda: self._land(
            warehouse.commune_context(self.dpe, self.social, self.construction), "context"))

    @property
    def panel(self):
        sold = self.sold(
            "annee", "date_mutation", "code_commune", "code_departement", "type_local", "prix_m2",
            "surface_reelle_bati", "nombre_pieces_principales")
        return self._once("panel", lambda: features.panel_commune_mois(
            sold, self.communes, self.ecln_year))

    @property
    def features(self):
        return self._once("features", lambda: features.rpt_features_commune_mois(self.panel))


for _id, _name in (("T02", "dvf"), ("T03", "dpe"), ("T04", "sitadel"), ("T05", "ecln"),
                   ("T07", "rpls")):
    query(f"{_id}_stg_{_name}", select(f"stg_{_name}"))(
        lambda spark, sf, name=_name: Warehouse(spark, sf).stg(name)
    )


def _bucketed(spark, df: DataFrame, label: str, keys: list[str], buckets: int = 16) -> DataFrame:
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    return sinks.bucketed(df, name, keys, buckets, location=fresh_path(spark, name))


@query("T02_stg_dvf_bucketed", select("stg_dvf"))
def stg_dvf_bucketed(spark, sf):
    """Deduplication of a raw table that is bucketed by its identifier: no exchange."""
    raw = _bucketed(spark, roles.raw_dvf(spark, sf), "raw_dvf", ["id_mutation"])
    return staging.stg_dvf(raw)


@query("A12_fct_transactions", select("fct_transactions"))
def fct_transactions(spark, sf):
    return Warehouse(spark, sf).transactions


@query("A13_fct_dpe_commune", select("fct_dpe_commune"))
def fct_dpe_commune(spark, sf):
    return Warehouse(spark, sf).dpe


@query("A14_fct_construction", select("fct_construction"))
def fct_construction(spark, sf):
    return Warehouse(spark, sf).construction


@query("A15_fct_logement_social", select("fct_logement_social"))
def fct_logement_social(spark, sf):
    return Warehouse(spark, sf).social


@query("A16_fct_marche_neuf", select("fct_marche_neuf"))
def fct_marche_neuf(spark, sf):
    return Warehouse(spark, sf).marche_neuf


@query("A18_dim_commune", select("dim_commune"))
def dim_commune(spark, sf):
    w = Warehouse(spark, sf)
    return warehouse.dim_commune(w.stg("dvf"), w.stg("rpls"))


@query("A19_dim_departement", select("dim_departement"))
def dim_departement(spark, sf):
    return Warehouse(spark, sf).departements


@query("A20_int_ecln_dept_annee", select("int_ecln_dept_annee"))
def int_ecln(spark, sf):
    return Warehouse(spark, sf).ecln_year


@query("A21_int_rpls_commune", select("fct_logement_social"))
def int_rpls(spark, sf):
    return warehouse.int_rpls_commune(Warehouse(spark, sf).social)


@query("A21_int_sitadel_commune", select("fct_construction"))
def int_sitadel(spark, sf):
    return warehouse.int_sitadel_commune(Warehouse(spark, sf).construction)


@query("A22_fct_transactions_enriched",
       compose(f"SELECT {', '.join(warehouse.ENRICHED_COLUMNS)} FROM fct_transactions_enriched"))
def enriched(spark, sf):
    w = Warehouse(spark, sf, landed=True)
    return warehouse.enriched_transactions(w.transactions, w.communes, w.ecln_year)


@query("A22_enriched_bucketed",
       compose(f"SELECT {', '.join(warehouse.ENRICHED_COLUMNS)} FROM fct_transactions_enriched"))
def enriched_bucketed(spark, sf):
    """Transactions and contexts bucketed by year and commune: joined without an exchange."""
    w = Warehouse(spark, sf, landed=True)
    keys = warehouse.COMMUNE_YEAR
    return warehouse.enriched_transactions(
        _bucketed(spark, w.transactions, "transactions", keys),
        _bucketed(spark, w.communes, "communes", keys), w.ecln_year)


@query("A23_rpt_prix_commune", select("rpt_prix_commune"))
def rpt_prix_commune(spark, sf):
    return warehouse.rpt_prix_commune(Warehouse(spark, sf, clustered=True).sold(
        "annee", "code_commune", "nom_commune", "code_departement", "type_local", "prix_m2",
        "valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales"))


@query("A24_rpt_dynamique_marche_dept", select("rpt_dynamique_marche_dept"))
def rpt_dynamique(spark, sf):
    w = Warehouse(spark, sf, landed=True)
    return warehouse.rpt_dynamique_marche_dept(
        w.sold("annee", "code_departement", "prix_m2", "surface_reelle_bati"), w.ecln_year, w.construction, w.dpe, w.departements)


@query("A25_rpt_tension_immobiliere_dept", select("rpt_tension_immobiliere_dept"))
def rpt_tension(spark, sf):
    w = Warehouse(spark, sf, landed=True)
    return warehouse.rpt_tension_immobiliere_dept(
        w.sold("annee", "code_departement", "type_local", "prix_m2", "surface_reelle_bati"), w.ecln_year, w.construction, w.social, w.departements)


@query("A26_rpt_performance_energetique_dept", select("rpt_performance_energetique_dept"))
def rpt_energy(spark, sf):
    w = Warehouse(spark, sf)
    return warehouse.rpt_performance_energetique_dept(w.dpe, w.departements)


@query("A27_panel_commune_mois", select("panel_commune_mois"))
def panel(spark, sf):
    return Warehouse(spark, sf, landed=True).panel


@query("A28_rpt_features_commune_mois", select("rpt_features_commune_mois"))
def rpt_features(spark, sf):
    return Warehouse(spark, sf, landed=True).features


#: Columns of the transactions that the cross-section reads.
SECTION = (
    "annee", "code_commune", "code_departement", "type_local", "prix_m2", "surface_reelle_bati",
    "nombre_pieces_principales")


@query("A29_rpt_shap_commune", select("rpt_shap_commune"))
def rpt_shap_commune(spark, sf):
    w = Warehouse(spark, sf, landed=True)
    return features.rpt_shap_commune(w.sold(*SECTION), w.communes, w.ecln_year)


def lots_dense(spark, sf):
    """Lots with the supplier as entity: few entities, nearly every month present."""
    items, supplier = roles.table(spark, sf, "lineitem"), roles.table(spark, sf, "supplier")
    kind = F.when(F.col("l_returnflag") == "A", "Appartement").when(
        F.col("l_returnflag") == "R", "Maison").otherwise("Dépendance")
    return items.join(supplier, items.l_suppkey == supplier.s_suppkey).select(
        F.col("s_suppkey").cast("string").alias("code_commune"),
        F.col("s_nationkey").cast("string").alias("code_departement"),
        F.to_date("l_shipdate").alias("date_mutation"), F.year("l_shipdate").alias("annee"),
        kind.alias("type_local"), F.col("l_quantity").alias("surface_reelle_bati"),
        F.col("l_linenumber").alias("nombre_pieces_principales"),
        settle(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("prix_m2"),
    )


def panel_dense(spark, sf):
    # The quantiles of the panel read the lots more than once: join them once, pruned.
    return features.panel_commune_mois(cut_lineage(lots_dense(spark, sf), "lots"))


def panel_mean(spark, sf):
    return features.monthly_means(lots_dense(spark, sf))


def features_dense(spark, sf):
    return features.rpt_features_commune_mois(panel_dense(spark, sf))


def features_wide(spark, sf):
    """The feature panel with all its context, on the dense lots: every sequence feature."""
    w = Warehouse(spark, sf, landed=True, lots=False)
    lots = cut_lineage(lots_dense(spark, sf), "lots")
    return features.rpt_features_commune_mois(
        features.panel_commune_mois(lots, w.communes, w.ecln_year))


@query("A30_rpt_shap_sample", compose("""
SELECT * FROM features_dense WHERE prix_m2_lag_12m IS NOT NULL AND nb_transactions >= 5
  AND prix_m2_moy > 0
  AND ('0x' || substr(md5(code_commune || ',' || annee || ',' || mois), 1, 8))::BIGINT % 20 = 0"""))
def rpt_shap_sample(spark, sf):
    return features.rpt_shap_sample(features_dense(spark, sf))
