"""Raw account sources (S1, S2) and sinks.

S1/S2: the source CSV is read with an explicit schema (never inferred) in FAILFAST
mode, the ``default`` column is renamed to ``default_raw`` and accounts get the
contiguous surrogate key 1..n in file order (the SERIAL column of the landing
table). File order is (file, split offset, row in split); numbering it uses the
distributed positions operator, so no task or driver ever holds the whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import CSV_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from ..session import materialize


def read_raw_csv(spark: SparkSession, path: str, header: bool = True, lenient: bool = False,
                 allow_extra_columns: bool = False, first_id: int = 1) -> DataFrame:
    """CSV in the delivered shape (CSV_SCHEMA columns, any order) -> landing rows (RAW_SCHEMA).

    Columns are matched by header name, read as text (no inference) and cast to the declared
    types. Strict: a malformed number or a malformed line fails the load, like the typed bulk
    load. Lenient: the value becomes NULL (``try_cast``) and the audits report it."""
    mode = "PERMISSIVE" if lenient else "FAILFAST"
    text = spark.read.option("header", header).option("mode", mode).csv(path)
    missing = [f.name for f in CSV_SCHEMA.fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"CSV at {path} lacks column(s): {', '.join(missing)}")
    # Raw schema only: an already engineered file (mapped labels such as 'Graduate School')
    # would silently turn into 'Unknown' labels, so extra columns are refused by default.
    extra = [c for c in text.columns if c not in CSV_SCHEMA.names]
    if extra and not allow_extra_columns:
        raise ValueError(f"CSV at {path} is not the raw delivery; unexpected column(s): {', '.join(extra)}")
    ordered = text.select(
        *[(F.col(f"`{f.name}`").try_cast(f.dataType) if lenient else F.col(f"`{f.name}`").cast(f.dataType))
          .alias(f.name) for f in CSV_SCHEMA.fields],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    numbered = number_by_split(materialize(ordered, "delivery"), "customer_id", first_id)
    return numbered.withColumnRenamed("default", "default_raw").select(*RAW_COLUMNS)


def number_by_split(rows: DataFrame, id_col: str, first: int = 1) -> DataFrame:
    """Contiguous ids in file order for stored rows with ``_file``, ``_block`` and ``_row`` (a
    scan's file, split offset and ``monotonically_increasing_id``; rows of a split are numbered
    without gaps). One row per split is counted; the running total over them is a window over
    as many rows as there are splits (one per 128 MB of input), and so large is the table that
    the rows are joined with."""
    splits = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_low"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_block", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = rows.join(offsets, ["_file", "_block"])
    return placed.withColumn(id_col, (F.col("_offset") + F.col("_row") - F.col("_low") + F.lit(first)).cast("bigint")).drop(
        "_file", "_block", "_row", "_low", "_offset")


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Landing table already keyed (RAW_SCHEMA) stored as Parquet."""
    return spark.read.schema(RAW_SCHEMA).parquet(path).select(*RAW_COLUMNS)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header (one file per partition, written by the executors).
    Values are written as they are: Spark's default of trimming blanks is turned off."""
    (df.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv_as(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A file that ``write_csv`` has written, with its types back (an empty field is NULL)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Idempotent table write (overwrite replaces the previous build)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
