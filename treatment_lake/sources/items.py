"""Item export files (one tagged-JSON item per line).

The reference pages through the document store into one driver-side list.
Here the items are export files read in parallel by the JSON source with
a fixed schema (no inference pass, no driver materialisation); an empty
or missing export yields an empty frame with the same schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tags import ITEM_SCHEMA
from ..operators.silver import items_json
from .layers import path_exists

CORRUPT = "_corrupt_line"


#: a gzip file is read by one task: this many lines, some 50 MB of text
MAX_LINES = 50_000


def write_lines(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Lines of text -> export files, in gzip at its fastest (items repeat their names: about a tenth is left)."""
    (lines.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", MAX_LINES).text(path))


def write_items(flat: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Typed records -> item export files (one item per line)."""
    write_lines(items_json(flat), path, mode)


def item_file_schema() -> T.StructType:
    return T.StructType([*ITEM_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])


def item_reader(reader):
    """A batch or stream reader set up for item files. A line that is no item has a NULL ``Item`` and, if it is no JSON of
    this shape, its text in ``CORRUPT``."""
    return reader.schema(item_file_schema()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan item files (one path, or a list of files) with the fixed item schema; a missing or empty export gives an empty frame."""
    if not path or (isinstance(path, str) and not path_exists(spark, path)):
        return spark.createDataFrame([], item_file_schema())
    return item_reader(spark.read).option("ignoreMissingFiles", "true").json(path)


def listed_files(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """``path, modified`` of the files of an export, from the listing: no content is read. ``modified_after`` (a UTC
    timestamp) leaves out older ones."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, modified timestamp")
    reader = spark.read.format("binaryFile")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"))


def is_item() -> Column:
    return F.col("Item").isNotNull() & F.col(CORRUPT).isNull()


def with_file(items: DataFrame) -> DataFrame:
    """With ``_file``, the place of the file a line comes from (as a URI)."""
    from_files = bool(items.inputFiles())
    return items.withColumn("_file", F.col("_metadata.file_path") if from_files else F.lit(None).cast("string"))


def bad_files() -> Column:
    """``bad_files``: the files that hold lines that are no items (as many names at most as the export has files), to be read again."""
    return F.collect_set(F.when(~is_item(), F.col("_file"))).alias("bad_files")


def bad_line() -> Column:
    """Text of a line that is no item, NULL for an item."""
    return F.when(~is_item(), F.coalesce(F.col(CORRUPT), F.to_json("Item"), F.lit("{}")))


def bad_lines(items: DataFrame) -> DataFrame:
    """``line`` of every line that is no item."""
    return items.where(~is_item()).select(bad_line().alias("line"))


def modified_at() -> Column:
    return F.col("Item.metadata.M")["modified_at"]["S"].try_cast("timestamp_ntz")


def scan_items_window(items: DataFrame, lo=None, hi=None, keep_unknown: bool = False, with_ties: bool = False) -> DataFrame:
    """Items whose nested ``metadata.modified_at`` lies in ``(lo, hi]`` (either bound optional), with ``with_ties`` in ``[lo, hi]``.

    ``keep_unknown`` also keeps items without a readable time: no window says whether they are new, and upserts
    make reading them again harmless."""
    ts = modified_at()
    cond = F.lit(True)
    if lo is not None:
        low = F.lit(lo).cast("timestamp_ntz")
        cond = cond & (ts >= low if with_ties else ts > low)
    if hi is not None:
        cond = cond & (ts <= F.lit(hi).cast("timestamp_ntz"))
    return items.where((cond | ts.isNull()) if keep_unknown else cond)
