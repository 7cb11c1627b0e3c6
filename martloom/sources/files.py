"""File sources: transactions, weekly macro drivers, data dictionary, dimensions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_nulls

# Columns and types of the raw files.
TRANSACTION_TYPES = {
    "date": "date",
    "year": "int",
    "month": "int",
    "week_of_year": "int",
    "region": "string",
    "product_category": "string",
    "sku": "string",
    "channel": "string",
    "customer_type": "string",
    "units": "int",
    "unit_price": "double",
    "revenue": "double",
    "housing_starts_index": "double",
    "lumber_price_index": "double",
    "mortgage_rate": "double",
}
MACRO_TYPES = {
    "week": "date",
    "housing_starts_index": "double",
    "lumber_price_index": "double",
    "mortgage_rate": "double",
    "season_factor": "double",
}
DICTIONARY_TYPES = {"column": "string", "type": "string", "description": "string"}
DICTIONARY_TO_SPARK = {"date": "date", "int": "int", "float": "double"}


class MissingSource(FileNotFoundError):
    pass


class EmptySource(ValueError):
    pass


def struct_of(types: dict[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in types.items()))


def landing_struct(types: dict[str, str]) -> T.StructType:
    return struct_of({name: "string" for name in types})


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, origin: bool = False
) -> DataFrame:
    """CSV with a header that must agree with ``schema``; a missing path is an error.

    Nothing is inferred, so no extra pass over the file. Missing-value tokens become NULL.
    ``origin`` adds the file and a row number that is unique and ascending inside each file part.
    """
    try:
        raw = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .csv(path)
        )
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise MissingSource(path) from e
        raise
    if origin:
        raw = raw.select(
            "*",
            F.col("_metadata.file_path").alias("source_file"),
            F.monotonically_increasing_id().alias("row_no"),
        )
    return clean_nulls(raw)


def _not_empty(df: DataFrame, path: str) -> DataFrame:
    if df.isEmpty():
        raise EmptySource(path)
    return df


def scan_transactions(spark: SparkSession, path: str, origin: bool = False) -> DataFrame:
    """Raw transactions, every column as text: typing is decided cell by cell later."""
    return _not_empty(scan_csv(spark, path, landing_struct(TRANSACTION_TYPES), origin), path)


def scan_macro(spark: SparkSession, path: str) -> DataFrame:
    return _not_empty(scan_csv(spark, path, struct_of(MACRO_TYPES)), path)


def scan_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Optional source: an empty table when the file is missing."""
    schema = struct_of(DICTIONARY_TYPES)
    try:
        return scan_csv(spark, path, schema)
    except MissingSource:
        return spark.createDataFrame([], schema)


def dictionary_schema(dictionary: DataFrame) -> T.StructType:
    """Schema declared by a dictionary of a few rows; other type names are text."""
    rows = dictionary.select("column", "type").collect()
    return struct_of({r["column"]: DICTIONARY_TO_SPARK.get(r["type"], "string") for r in rows})


def scan_dimension(spark: SparkSession, path: str, id_column: str, key: str) -> DataFrame:
    """Id and natural key only; the other columns are never read."""
    return spark.read.parquet(path).select(id_column, key)


def summarise(df: DataFrame, source: str, date_column: str | None = None) -> DataFrame:
    """Rows, column count and date range of a source in one aggregate."""
    day = F.col(date_column).cast("date") if date_column else F.lit(None).cast("date")
    return df.agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
