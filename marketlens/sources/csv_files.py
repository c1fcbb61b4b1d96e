"""Reference-format CSV files (A1, A5): nine headed CSVs read with explicit schemas, and
the one set of options with which results are written as CSV and read back (A2, B2)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.repair import repair_categories, repair_geolocation
from marketlens.sources.marketplace import Marketplace
from marketlens.sources.schemas import SCHEMAS, csv_file_names
from marketlens.sources.split_csv import read_quoted_csv

# Tables whose text may span lines: read by ``split_csv``, in splits like the others.
MULTI_LINE = ("order_reviews",)
BAD_RECORD = "_bad_record"

# An absent value is an empty field, an empty string a quoted one.  The reader tells them
# apart by a marker that no text consists of (a private-use character).
_COMMON = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
           "ignoreTrailingWhiteSpace": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
CSV_WRITE = {**_COMMON, "nullValue": "", "emptyValue": '""'}
CSV_READ = {**_COMMON, "nullValue": "\ue000", "emptyValue": "", "multiLine": "true", "mode": "FAILFAST",
            "enforceSchema": "false"}


# One record of a multi-line file, as the reader below parses its files.
CSV_RECORD = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


class MissingInput(FileNotFoundError):
    """A required input path does not exist (A5)."""


def is_missing_path(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


@contextmanager
def input_needed(table: str, path: str) -> Iterator[None]:
    """A5: a path that isn't there, and nothing else, is a missing input."""
    try:
        yield
    except AnalysisException as exc:  # raised while resolving
        if not is_missing_path(exc):
            raise
        raise MissingInput(f"{table}: input not found at {path}") from exc


def file_position() -> Column:
    """Where a row stands in its input: file, then place in the file.  A sortable string;
    row numbers alone follow the order in which Spark plans the files."""
    return F.concat_ws("|", F.col("_metadata.file_path"),
                       F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
                       F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))


def _reader(spark: SparkSession, table: str):
    return (spark.read.option("header", True).option("multiLine", table in MULTI_LINE)
            .option("escape", '"').option("enforceSchema", False).option("mode", "PERMISSIVE"))


def read_csv_table(spark: SparkSession, path: str, table: str,
                   with_position: bool = False) -> DataFrame:
    """A1: headed CSV with the table's schema; the header must name its columns in order.
    Review text may span lines and hold quotes.  ``with_position`` adds ``input_pos``
    (file order) for keep-first dedup.  See ``type_violations`` for bad values."""
    with input_needed(table, path):
        if table in MULTI_LINE:
            return read_quoted_csv(spark, path, SCHEMAS[table], CSV_RECORD,
                                   position="input_pos" if with_position else None)
        df = _reader(spark, table).schema(SCHEMAS[table]).csv(path)
    if with_position:
        df = df.withColumn("input_pos", file_position())
    return df


def input_report(spark: SparkSession, data_dir: str, files: dict[str, str]) -> DataFrame:
    """A5 for a whole folder: (table_name, status, rows, path); a file that isn't there is
    ``missing``, and the others are counted all the same."""
    found = []
    for table, name in files.items():
        path = f"{data_dir.rstrip('/')}/{name}"
        try:
            found.append((table, "found", read_csv_table(spark, path, table).count(), path))
        except MissingInput:
            found.append((table, "missing", None, path))
    return spark.createDataFrame(found, "table_name string, status string, rows long, path string")


def type_violations(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows whose values don't fit the table's types (or that have too many or too few
    fields), counted: one row (table_name, n_bad_rows, first_bad_row, digest), the last over
    all values as they were read."""
    schema = T.StructType([*SCHEMAS[table].fields, T.StructField(BAD_RECORD, T.StringType())])
    df = _reader(spark, table).schema(schema).option("columnNameOfCorruptRecord", BAD_RECORD).csv(path)
    # the digest makes the scan parse every column; with fewer, bad values go unseen
    return df.agg(
        F.lit(table).alias("table_name"), F.count_if(F.col(BAD_RECORD).isNotNull()).alias("n_bad_rows"),
        F.min(BAD_RECORD).alias("first_bad_row"), F.bit_xor(F.xxhash64(*SCHEMAS[table].fieldNames())).alias("digest"))


def read_marketplace_csv(spark: SparkSession, data_dir: str, prefix: str = "",
                         files: dict[str, str] | None = None) -> Marketplace:
    """All nine tables from a folder of reference-format CSV files, repaired.
    File names follow ``csv_file_names(prefix)`` unless ``files`` maps them."""
    names = files or csv_file_names(prefix)
    path = {t: f"{data_dir.rstrip('/')}/{name}" for t, name in names.items()}
    geo_raw = read_csv_table(spark, path["geolocation"], "geolocation", with_position=True)
    sellers = read_csv_table(spark, path["sellers"], "sellers", with_position=True)
    customers = read_csv_table(spark, path["customers"], "customers", with_position=True)
    cat_raw = read_csv_table(spark, path["prodcategory"], "prodcategory", with_position=True)
    products = read_csv_table(spark, path["products"], "products")
    return Marketplace(
        geolocation=repair_geolocation(geo_raw, sellers, customers),
        customers=customers.drop("input_pos"),
        orders=read_csv_table(spark, path["orders"], "orders"),
        sellers=sellers.drop("input_pos"),
        prodcategory=repair_categories(cat_raw, products),
        products=products,
        order_items=read_csv_table(spark, path["order_items"], "order_items"),
        order_payments=read_csv_table(spark, path["order_payments"], "order_payments"),
        order_reviews=read_csv_table(spark, path["order_reviews"], "order_reviews"),
        geolocation_raw=geo_raw,
        prodcategory_raw=cat_raw,
    )
