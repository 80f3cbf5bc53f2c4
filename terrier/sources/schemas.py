"""Tables of the warehouse: columns, replacing key, version, partition column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "DATE": T.DateType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(),
}


@dataclass(frozen=True)
class TableSpec:
    """A declared table. ``ties`` settle equal versions of one key."""

    name: str
    columns: str
    keys: tuple[str, ...]
    version: str = "_loaded_at"
    ties: tuple[str, ...] = ()
    partition: str | None = None
    notes: str = field(default="", compare=False)

    @property
    def schema(self) -> T.StructType:
        """Built without a session, so that modules can read it on import."""
        pairs = [c.split() for c in f"{self.columns}, {self.version} TIMESTAMP".split(",")]
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

    @property
    def all_ties(self) -> list[str]:
        """The declared ties, then every other data column, so that only equal rows tie."""
        rest = [c for c in self.data_columns if c not in (*self.keys, *self.ties)]
        return [*self.ties, *rest]

    @property
    def data_columns(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name != self.version]


# Column names, types and keys of the source tables.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "raw_dvf",
            "id_mutation STRING, date_mutation DATE, annee INT, nature_mutation STRING, "
            "valeur_fonciere DOUBLE, adresse_numero STRING, adresse_nom_voie STRING, "
            "code_postal STRING, code_commune STRING, nom_commune STRING, "
            "code_departement STRING, id_parcelle STRING, type_local STRING, "
            "surface_reelle_bati DOUBLE, nombre_pieces_principales INT, "
            "surface_terrain DOUBLE, latitude DOUBLE, longitude DOUBLE",
            keys=("annee", "code_commune", "id_mutation", "id_parcelle", "type_local"),
            ties=("date_mutation", "valeur_fonciere", "surface_reelle_bati",
                  "nombre_pieces_principales", "latitude", "longitude", "adresse_numero"),
            partition="annee",
        ),
        TableSpec(
            "raw_dpe",
            "numero_dpe STRING, date_etablissement_dpe DATE, annee INT, code_commune STRING, "
            "code_departement STRING, etiquette_dpe STRING, consommation_energie_primaire DOUBLE, "
            "consommation_energie_finale DOUBLE, emission_ges DOUBLE, "
            "type_energie_principale_chauffage STRING, type_installation_chauffage STRING, "
            "surface_habitable_logement DOUBLE, periode_construction STRING, type_batiment STRING",
            keys=("annee", "code_commune", "numero_dpe"),
            ties=("date_etablissement_dpe", "etiquette_dpe", "consommation_energie_primaire",
                  "surface_habitable_logement"),
            partition="annee",
        ),
        TableSpec(
            "raw_sitadel",
            "annee INT, mois INT, code_commune STRING, code_departement STRING, "
            "type_logement STRING, nb_logements_autorises INT, nb_logements_commences INT, "
            "surface_autorisee DOUBLE, surface_commencee DOUBLE",
            keys=("annee", "mois", "code_commune", "type_logement"),
            ties=("nb_logements_autorises", "nb_logements_commences", "surface_autorisee",
                  "surface_commencee"),
            partition="annee",
        ),
        TableSpec(
            "raw_ecln",
            "annee INT, trimestre INT, code_departement STRING, libelle_departement STRING, "
            "type_logement STRING, nb_mises_en_vente INT, nb_reservations INT, "
            "nb_annulations INT, stock INT, delai_ecoulement DOUBLE, prix_m2 DOUBLE, "
            "prix_moyen_individuel DOUBLE",
            keys=("annee", "trimestre", "code_departement", "type_logement"),
            ties=("nb_mises_en_vente", "nb_reservations", "stock", "prix_m2"),
        ),
        TableSpec(
            "raw_eptb",
            "annee INT, zone_code STRING, zone_libelle STRING, nb_terrains INT, "
            "prix_terrain_m2_moy DOUBLE, prix_terrain_m2_med DOUBLE, surface_terrain_moy DOUBLE, "
            "prix_terrain_total DOUBLE, nb_maisons INT, prix_maison_m2_moy DOUBLE, "
            "prix_maison_m2_med DOUBLE, surface_maison_moy DOUBLE, prix_maison_total DOUBLE",
            keys=("annee", "zone_code"),
            ties=("zone_libelle", "nb_terrains", "nb_maisons", "prix_terrain_total",
                  "prix_maison_total"),
        ),
        TableSpec(
            "raw_rpls",
            "annee INT, code_commune STRING, code_departement STRING, code_region STRING, "
            "financement STRING, classe_energie_dpe STRING, annee_construction INT, "
            "surface DOUBLE, nb_pieces INT",
            keys=("annee", "code_commune", "financement"),
            ties=("surface", "nb_pieces", "annee_construction", "classe_energie_dpe",
                  "code_departement", "code_region"),
            partition="annee",
            notes="key coarser than one dwelling a row: counts downstream count funding types",
        ),
        TableSpec(
            "raw_insee_communes",
            "code_commune STRING, libelle_commune STRING, annee INT, "
            "revenu_disponible_median DOUBLE, taux_pauvrete DOUBLE, population_municipale INT, "
            "superficie DOUBLE, densite_population DOUBLE, part_proprietaires DOUBLE, "
            "solde_migratoire_net INT, part_logements_vacants DOUBLE",
            keys=("annee", "code_commune"),
            ties=("libelle_commune", "population_municipale", "revenu_disponible_median"),
            partition="annee",
        ),
        TableSpec(
            "raw_macro_taux",
            "date DATE, annee INT, mois INT, taux_credit_immobilier DOUBLE, "
            "taux_oat_10ans DOUBLE, duree_moyenne_credit DOUBLE, taux_inflation DOUBLE",
            keys=("date",),
            ties=("taux_credit_immobilier", "taux_oat_10ans", "duree_moyenne_credit",
                  "taux_inflation"),
        ),
        TableSpec(
            "_ingestion_watermarks",
            "source STRING, last_value STRING",
            keys=("source",), version="updated_at", ties=("last_value",),
        ),
        TableSpec(
            "_ingestion_commits",
            "source STRING, last_value STRING, table_name STRING, unit STRING, attempt STRING, n BIGINT",
            keys=("source",), version="updated_at", ties=("last_value",),
            notes="marks with the attempts that came with them",
        ),
        TableSpec(
            "preds_ml_prix_m2",
            "run_id STRING, code_commune STRING, annee_pred INT, mois_pred INT, "
            "prix_m2_pred FLOAT, prix_m2_reel FLOAT",
            keys=("run_id", "code_commune", "annee_pred", "mois_pred"),
            version="predicted_at", ties=("prix_m2_pred",),
        ),
        TableSpec(
            "preds_lstm_prix_m2",
            "run_id STRING, code_commune STRING, annee_pred INT, mois_pred INT, horizon INT, "
            "prix_m2_pred FLOAT, prix_m2_reel FLOAT",
            keys=("run_id", "code_commune", "annee_pred", "mois_pred", "horizon"),
            version="predicted_at", ties=("prix_m2_pred",),
        ),
        TableSpec(
            "model_perf_runs",
            "run_id STRING, model_name STRING, run_date TIMESTAMP, n_samples BIGINT, "
            "n_communes BIGINT, mae FLOAT, rmse FLOAT, mape FLOAT, horizon INT, "
            "annee_test INT, params STRING",
            keys=("run_id", "model_name", "horizon", "annee_test"),
            version="logged_at", ties=("run_date", "mae"),
            notes="annee_test is part of the key, so the folds of one run do not replace each other",
        ),
    )
}


def declare_table(
    spark: SparkSession, spec: TableSpec, name: str | None = None, location: str | None = None
) -> str:
    """Create the table if it is absent, with its fixed schema.

    ``location`` puts its files there instead of the warehouse folder.
    """
    name = name or spec.name
    by = f" PARTITIONED BY ({spec.partition})" if spec.partition else ""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({spec.columns}, {spec.version} TIMESTAMP) "
        f"USING parquet{by}{at}"
    )
    return name


def scan_source(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Read a declared table: from a path with the fixed schema, or from the catalogue."""
    if path is None:
        return spark.table(name)
    return spark.read.schema(TABLES[name].schema).parquet(path)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast to the declared types; declared columns the source lacks become NULL."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spec.schema.fields
        if f.name != spec.version or f.name in have
    ])
