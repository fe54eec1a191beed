"""CSV / Parquet I/O and object listings on any Hadoop path (``file:``, ``s3a:``, ``abfss:`` ...).

Executors read and write the paths directly; nothing is staged on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions.names import last_path_component

# The CSV dialect of the landed and exported files (header line,
# comma, double-quote quoting with a doubled quote as escape).
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
}


# What the header CSV must keep as it is: outer blanks, empty text apart from NULL, and microseconds.
CSV_WRITE_OPTIONS = CSV_OPTIONS | {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a header CSV, in file order (reads the first line of one file; no content is parsed)."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path).columns


def text_schema(names: Iterable[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_csv_text(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Header CSV with every column as text, by name, in the order of its header.

    ``enforceSchema=false`` checks each file's header against it, so a file with another column order is an error
    instead of swapped values.
    """
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("multiLine", "true" if multiline else "false")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .schema(text_schema(csv_header(spark, path)))
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass, no type drift).

    ``multiline`` keeps quoted line breaks inside free-text fields; it makes each
    file one split, so land large CSV drops once into Parquet and read that.
    """
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("multiLine", "true" if multiline else "false")
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV as a directory of part files, written in parallel (no coalesce(1))."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> None:
    writer = df.write.mode(mode)
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


def write_split_by_label(df: DataFrame, path: str, label_col: str, mode: str = "overwrite") -> None:
    """Write one dataset partitioned by a label column in a single pass.

    Each label lands in ``<path>/<label_col>=<value>/``; a reader filtering on the
    label prunes the other directories.
    """
    write_parquet(df, path, mode=mode, partition_by=[label_col])


def list_files(spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """Listing ``(path, name, length)`` of the files under ``root``.

    Uses the binary-file source with only ``path`` and ``length`` selected, so file
    contents are never read (ReadSchema is ``struct<path,length>``).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    listing = reader.load(root).select("path", "length")
    return listing.select("path", last_path_component("path").alias("name"), "length")


def copy_datasets(spark: SparkSession, sources: dict[str, str], target_root: str) -> dict[str, str]:
    """Copy each Parquet dataset to ``<target_root>/<name>`` (overwrite).

    A frozen copy of a set of stage tables; the copy is a parallel read/write per
    dataset, never a byte copy through the driver. Never aim ``target_root`` at a
    folder that holds one of the sources.
    """
    out = {}
    target_root = target_root.rstrip("/")
    for name, src in sources.items():
        dst = f"{target_root}/{name}"
        if dst.rstrip("/") == src.rstrip("/"):
            raise ValueError(f"snapshot target equals its source: {src}")
        write_parquet(spark.read.parquet(src), dst)
        out[name] = dst
    return out


def snapshot_frames(frames: dict[str, DataFrame], target_root: str) -> dict[str, str]:
    """Write each DataFrame to ``<target_root>/<name>`` as Parquet (overwrite).

    Written stages are copied by a parallel read/write; unwritten ones are
    computed and written once.
    """
    out = {}
    target_root = target_root.rstrip("/")
    for name, df in frames.items():
        dst = f"{target_root}/{name}"
        write_parquet(df, dst)
        out[name] = dst
    return out


def expected_manifest(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """A one-column DataFrame of expected object names."""
    return spark.createDataFrame([(n,) for n in names], "name string")


def manifest_presence(listing: DataFrame, expected: DataFrame) -> DataFrame:
    """``(name, present)`` for every expected name, from a listing's ``name`` column."""
    found = listing.select("name").distinct().withColumn("present", F.lit(True))
    return expected.join(found, "name", "left").select(
        "name", F.coalesce(F.col("present"), F.lit(False)).alias("present")
    )


def manifest_missing(listing: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected names absent from the listing (empty when the set is complete)."""
    return expected.join(listing.select("name"), "name", "left_anti")
