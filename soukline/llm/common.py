"""Helpers shared by the operators: table scans, intermediate tables, word columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soukline.session import run_dir

# ASCII white space, as every contract of this package means it
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread of the files, not a recomputation,
    and every later use reads the same rows. ``files``: see :func:`file_count`.
    """
    path = run_dir(df.sparkSession, tag)
    if files:
        df = df.coalesce(files)
    # the rows are stored, so the shuffle files of this execution are not needed after it
    df.sparkSession.conf.set(SHUFFLE_CLEANUP, "true")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table written by :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for root in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)


# rows of one batch that Python gets: texts may be long, and a worker holds several batches
ARROW_ROWS = 1000


def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Batches that Python gets have at most ``rows`` rows, which bounds the memory of the
    workers; the setting holds for every execution of the session from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def map_arrow(df: DataFrame, run, schema, rows: int = ARROW_ROWS) -> DataFrame:
    """``df.mapInArrow`` in batches of at most ``rows`` rows (see :func:`arrow_rows`)."""
    arrow_rows(df.sparkSession, rows)
    return df.mapInArrow(run, schema)


TEXT_A_FILE = 16 << 20  # bytes of text
ROW_BYTES = 512         # what a document brings besides its text: ids, names, keys


def file_count(docs: DataFrame) -> int:
    """How many files a table made from the texts of ``docs`` is worth: one for every
    ``TEXT_A_FILE`` bytes, one a core at least.

    Tables with more partitions are coalesced to it before they are written: on a plain file
    system the executor starts two processes for every file that it opens for writing (Hadoop
    sets the permissions of the file and of its checksums with ``chmod``), and a join whose
    skewed partitions are split can leave thousands of files of a few kilobytes. No row moves
    for it, and the number grows with the texts."""
    size = docs.agg(F.sum(F.octet_length(text_or_empty()) + F.lit(ROW_BYTES).cast("long"))
                    ).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TEXT_A_FILE))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(col: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``, null counting as no word."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")
