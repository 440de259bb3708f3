"""File scans and writes (CSV, Parquet, landed JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def csv_scan(spark: SparkSession, path: str, schema: StructType | None = None,
             infer: bool = False, header: bool = True) -> DataFrame:
    """CSV directory scan. A declared ``schema`` is the production path (one pass);
    ``infer=True`` adds the inference pass over the data, as a notebook would."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def csv_scan_checked(spark: SparkSession, path: str, schema: StructType,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """CSV scan that loses nothing: (rows that fit the declared schema, the others).

    A line with a value that does not parse, or with too few or too many fields, is no
    row: it comes back as ``line`` (its text), ``parsed`` (what could be read of it, as
    JSON) and ``file``. Fields are checked whatever columns are used later."""
    raw = (spark.read.schema(StructType([*schema.fields, StructField(LINE, StringType())]))
           .option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", LINE).csv(path))
    names = schema.fieldNames()
    # always true, but names every field: Spark only converts, and so checks, those in use
    read = F.hash(*names) >= -(1 << 31)
    rejects = raw.filter(F.col(LINE).isNotNull() & read).select(
        F.col(LINE).alias("line"), F.to_json(F.struct(*names)).alias("parsed"),
        F.col("_metadata.file_name").alias("file"))
    return raw.filter(F.col(LINE).isNull() & read).select(*names), rejects


LINE = "_line"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def parquet_scan(spark: SparkSession, path: str,
                 schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def json_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed JSON documents with a declared schema (malformed fields -> NULL)."""
    return spark.read.schema(schema).json(path)


def land_documents(docs: DataFrame, path: str) -> str:
    """Land fetched documents as JSON Lines: one line per document with its keys and
    the raw response text in ``payload`` (many documents per file, not one file each)."""
    docs.write.mode("errorifexists").json(path)
    return path


def document_scan(spark: SparkSession, path: str, key_schema: StructType) -> DataFrame:
    """Scan landed documents: declared key columns plus the raw ``payload`` text."""
    return json_scan(spark, path, StructType(list(key_schema.fields)
                                             + [StructField("payload", StringType())]))
