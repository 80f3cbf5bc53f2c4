"""Readers of landed files: CSV, gzip CSV, JSON pages, catalogues of vintages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: list[str]) -> T.StructType:
    """Every column as text: values are coerced by the parsers, never inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Texts that mean a missing value in the source files.
MISSING = ("NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None", "#N/A", "<NA>")


def read_csv(
    spark: SparkSession, path: str, sep: str = ";", missing: tuple[str, ...] = MISSING,
    line_breaks: bool = True,
) -> DataFrame:
    """CSV with a header, all columns as text.

    A quoted value may hold the separator, doubled quotes and, with ``line_breaks``,
    line breaks; a file is then read by one task. Where no value has line breaks, False
    lets Spark split large uncompressed files. Texts in ``missing`` become NULL.

    The columns are those of the header, so an unknown or missing one does no
    harm; the parsers pick what they know. Files of one path must agree: a file
    whose header differs fails the job instead of shifting its columns.
    """
    options = {"sep": sep, "header": True, "inferSchema": False, "quote": '"', "escape": '"',
               "multiLine": line_breaks}
    names = spark.read.options(**options).csv(path).columns
    reader = spark.read.options(**options, enforceSchema=False)
    rows = reader.schema(text_schema(names)).csv(path)
    quoted = {n: F.col("`" + n.replace("`", "``") + "`") for n in names}
    return rows.select(*[F.when(~c.isin(*missing), c).alias(n) for n, c in quoted.items()])


def read_plain_csv(spark: SparkSession, path: str) -> DataFrame:
    """Uncompressed comma-separated file(s)."""
    return read_csv(spark, path, ",")


def read_csv_gz(spark: SparkSession, path: str) -> DataFrame:
    """Gzip CSV. One task must unpack a whole file; its rows are then spread evenly."""
    return read_csv(spark, path, ",").hint("rebalance")


def read_json_pages(
    spark: SparkSession, path: str, record: T.StructType | str, data_key: str = "data",
    lines: bool = False,
) -> DataFrame:
    """Records of landed API pages, whatever the paging style.

    A page is one JSON object that holds a list of records under ``data_key``
    ('data' for offset and numbered pages, 'results' for cursor pages). The
    other keys of the envelope are not read. An empty page adds nothing. ``lines``
    reads files with one page a line, which Spark can split.
    """
    fields = T.StructType.fromDDL(record) if isinstance(record, str) else record
    envelope = T.StructType([T.StructField(data_key, T.ArrayType(fields))])
    pages = spark.read.schema(envelope).option("multiLine", not lines).json(path)
    return pages.select(F.inline(F.col(data_key)))


CATALOGUE = "datafiles ARRAY<STRUCT<rid: STRING, millesimes: ARRAY<STRUCT<millesime: STRING>>>>"


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE).option("multiLine", True).json(path)


def catalog_vintages(catalogue: DataFrame, dataset_id: str) -> DataFrame:
    """Vintages of one data file, ascending; no rows if it is not there."""
    files = catalogue.select(F.explode("datafiles").alias("f")).where(F.col("f.rid") == dataset_id)
    found = files.select(F.explode("f.millesimes").alias("m"))
    return found.select(F.col("m.millesime").alias("millesime")).distinct().orderBy("millesime")


def latest_vintage(catalogue: DataFrame, dataset_id: str) -> str:
    """Newest vintage; an error if there is none."""
    newest = catalog_vintages(catalogue, dataset_id).agg(F.max("millesime")).first()[0]
    if newest is None:
        raise LookupError(f"no vintage of {dataset_id} in the catalogue")
    return newest
