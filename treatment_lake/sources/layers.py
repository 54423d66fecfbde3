"""Parquet layer scans: safe reads, one run, latest file, file filters,
counts, load mode and the data watermark.

File facts come from the ``_metadata`` column of the file source
(``file_path``, ``file_modification_time``), aggregated on the executors;
nothing lists or opens files on the driver beyond Spark's own listing.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import WATERMARK_COLUMN


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path (or glob) names something on its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _nothing_there(error: AnalysisException) -> bool:
    """No such path, or no data file under it. Every other error is the caller's to see."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", glob: str | None = None, recursive: bool = False,
               ignore_corrupt: bool = False) -> DataFrame:
    """Read a layer; with a schema, a missing or empty path gives an empty frame.
    Unreadable files fail the job unless ``ignore_corrupt`` is set."""
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt)
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if schema is None or not _nothing_there(error):
            raise
        return spark.createDataFrame([], schema)


def layer_exists(spark: SparkSession, path: str) -> bool:
    """True when the path holds at least one readable data file."""
    if not path_exists(spark, path):
        return False
    try:
        df = spark.read.format("parquet").load(path)
    except AnalysisException as error:
        if not _nothing_there(error):
            raise
        return False
    return not df.select(F.lit(1)).isEmpty()


def load_mode(spark: SparkSession, path: str) -> str:
    """"full" for an empty/missing target layer, else "incremental"."""
    return "incremental" if layer_exists(spark, path) else "full"


def read_run(df: DataFrame, run_id: str, column: str = "ingest_run_id") -> DataFrame:
    """Only the rows of one ingest run; on a partition column this prunes files."""
    return df.where(F.col(column) == F.lit(run_id))


def with_file_facts(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file_path"),
                     F.col("_metadata.file_modification_time").alias("_file_mtime"))


def latest_file_rows(df: DataFrame, by: str = "name", unit: str = "file") -> DataFrame:
    """Rows of the newest file (``unit="file"``) or of the newest directory of
    files - one Spark write (``unit="dir"``), by path name (``by="name"``) or
    by modification time (``by="mtime"``).

    The newest unit is found from the files' facts (by name from the listing
    alone, by time from a scan that reads no column), and only its files are read.
    """
    spark, fmt = df.sparkSession, "parquet"
    if by == "name":
        files = df.inputFiles()
    else:
        newest = with_file_facts(df).agg(F.max_by("_file_path", F.struct("_file_mtime", "_file_path")).alias("p")).first()["p"]
        files = df.inputFiles() if newest is not None else []
    if not files:
        return df.limit(0)

    def unit_of(path: str) -> str:
        return path.rsplit("/", 1)[0] if unit == "dir" else path

    def plain(path: str) -> str:  # one spelling of a file's place for both sources of names
        return unquote(path).replace("file:///", "file:/")

    pick = unit_of(plain(newest)) if by != "name" else max(unit_of(plain(f)) for f in files)
    return spark.read.format(fmt).schema(df.schema).load([unquote(f) for f in files if unit_of(plain(f)) == pick])


def count_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """Row count of a stored table (Parquet answers from footers); None where there is no table."""
    try:
        return spark.read.format(fmt).load(path).count()
    except AnalysisException as error:
        if not _nothing_there(error):
            raise
        return None


def watermark(df: DataFrame, column: str = WATERMARK_COLUMN) -> DataFrame:
    """One-row frame: the max of ``column`` (NULL for an empty input)."""
    return df.agg(F.max(column).alias("watermark"))


def watermark_value(df: DataFrame, column: str = WATERMARK_COLUMN):
    """The watermark as a Python value (one scalar to the driver), so the
    incremental filter can be a literal that pushes down to the scan."""
    return watermark(df, column).first()["watermark"]


def incremental_filter(df: DataFrame, lo, hi=None, column: str = WATERMARK_COLUMN,
                       lookback: str | None = None, keep_unknown: bool = False) -> DataFrame:
    """Rows with ``lo < column <= hi``; ``lookback`` (an interval string such as
    '1 hour') re-reads an overlap below ``lo`` for late or tied rows - safe
    because upserts are idempotent. ``lo=None`` means no lower bound.
    ``keep_unknown`` also keeps rows whose ``column`` is NULL."""
    c = F.col(column)
    cond = F.lit(True)
    if lo is not None:
        low = F.lit(lo).cast("timestamp_ntz")
        if lookback:
            low = low - F.expr(f"INTERVAL {lookback}")
            cond = cond & (c >= low)
        else:
            cond = cond & (c > low)
    if hi is not None:
        cond = cond & (c <= F.lit(hi).cast("timestamp_ntz"))
    return df.where((cond | c.isNull()) if keep_unknown else cond)


def rows_at_watermark(df: DataFrame, column: str = WATERMARK_COLUMN) -> DataFrame:
    """Rows whose ``column`` equals its maximum (the latest batch). The maximum is taken first, as a literal the
    scan can use."""
    top = watermark_value(df, column)
    return df.limit(0) if top is None else df.where(F.col(column) == F.lit(top).cast(df.schema[column].dataType))
