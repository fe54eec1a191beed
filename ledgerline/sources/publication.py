"""A table published as one CSV file set: whole under its name, or not there at all.

A publication is a folder of versions and commits like a table of ``sources.versions``::

    <root>/v-<id>/header/       one file with the header line
    <root>/v-<id>/parts/        part files without a header, in row order
    <root>/v-<id>/manifest/     one row per part: number, name, bytes, lines, digest
    <root>/v-<id>/schema/       the table's schema, for a reader that wants its types back
    <root>/_commits/<number>    the version that became current

The header and then the parts by number, put one after another, are the CSV file of the table. Executors write the parts and
compute the digests; the commit is the last thing written, so a run that dies leaves the publication before it. A reader takes
the parts that the manifest names and no other file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.sources import versions
from ledgerline.sources.files import CSV_OPTIONS, CSV_WRITE_OPTIONS, list_files

NULL_MARK = "\ue000 no value \ue000"  # read in place of a missing value, never written
PART_ROWS = 1_000_000  # rows in a part file, at most
MANIFEST = "part_no int, part string, bytes long, lines long, digest decimal(38,0)"


class DamagedPublication(RuntimeError):
    """A part is missing, was changed or is not in the manifest."""


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """What lies in ``parts``: name, bytes, lines, and the exact sum of the hashes of its lines (0 for an empty part).

    Lines are streamed and large parts are split, so a part never has to fit in memory. The digest sees a lost, doubled or
    altered line; lines of one part that changed places are the one thing it does not see.
    """
    text = spark.read.option("lineSep", "\n").text(f"{path}/parts").select(F.col("_metadata.file_name").alias("part"), F.xxhash64("value").cast("decimal(38,0)").alias("hash"))
    lines = text.groupBy("part").agg(F.count("*").alias("lines"), F.sum("hash").alias("digest"))
    found = list_files(spark, f"{path}/parts", recursive=False).select(F.col("name").alias("part"), F.col("length").alias("bytes"))
    return found.join(lines, "part", "left").select("part", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("digest", F.lit(0)).cast("decimal(38,0)").alias("digest"))


def publish(df: DataFrame, root: str, order_by: Sequence[str] = (), part_rows: int = PART_ROWS) -> str:
    """Write ``df`` as the next version of the publication at ``root``, make it current, and return its folder.

    With ``order_by`` the rows are sorted over all parts (range partitions, no single task); without it a part holds the rows
    of a partition. Columns must be of types that CSV can hold. Of two writers that overlap, the second to finish gets
    ``versions.CommitConflict`` and its version is never visible.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    number = versions.last_number(spark, root) + 1
    version = f"v-{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    options = CSV_WRITE_OPTIONS | {"header": "false"}
    rows = df.orderBy(*order_by) if order_by else df
    rows.write.mode("errorifexists").options(**options).option("maxRecordsPerFile", part_rows).csv(f"{path}/parts")
    names = [F.lit(n).alias(f"c{i}") for i, n in enumerate(df.columns)]
    spark.range(1).select(*names).write.options(**options).csv(f"{path}/header")
    spark.range(1).select(F.lit(df.schema.json()).alias("schema")).write.text(f"{path}/schema")
    # Part files are numbered by their task and, within it, by their place: the order of their names.
    listing = [r.part for r in _parts(spark, path).select("part").orderBy("part").collect()]  # names only, one per part file
    numbered = spark.createDataFrame(list(enumerate(listing)), "part_no int, part string")
    _parts(spark, path).join(numbered, "part").select("part_no", "part", "bytes", "lines", "digest").write.parquet(f"{path}/manifest")
    versions.commit(spark, root, number, version)
    return path


def current(spark: SparkSession, root: str) -> str:
    """Folder of the current publication; ``versions.NoSuchVersion`` if there is none."""
    _, line = versions.last_commit(spark, root)
    if not line:
        raise versions.NoSuchVersion(f"{root}: nothing was published")
    return f"{root.rstrip('/')}/{line}"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{current(spark, root)}/manifest")


def check(spark: SparkSession, root: str) -> DataFrame:
    """One row per part that the manifest names or the folder holds: ``part``, ``intact``."""
    path = current(spark, root)
    want, have = manifest(spark, root), _parts(spark, path)
    same = F.lit(True)
    for c in ("bytes", "lines", "digest"):
        same = same & want[c].eqNullSafe(have[c])
    return want.join(have, want["part"] == have["part"], "full").select(F.coalesce(want["part"], have["part"]).alias("part"), same.alias("intact"))


def read(spark: SparkSession, root: str, checked: bool = True, multiline: bool = True) -> DataFrame:
    """The current publication with the types it was written with.

    ``checked`` compares every part with the manifest first (one pass over the files) and raises ``DamagedPublication``.
    ``multiline`` keeps quoted line breaks inside texts; a part is then one task, which ``part_rows`` bounds.
    """
    path = current(spark, root)
    if checked:
        bad = check(spark, root).filter("NOT intact").orderBy("part").limit(20).collect()
        if bad:
            raise DamagedPublication(f"{path}: {', '.join(r.part for r in bad)}")
    schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    parts = [f"{path}/parts/{r.part}" for r in manifest(spark, root).filter("bytes > 0").orderBy("part_no").select("part").collect()]
    if not parts:
        return spark.createDataFrame([], schema)
    options = CSV_OPTIONS | {"header": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    options |= {k: v for k, v in CSV_WRITE_OPTIONS.items() if k.startswith("timestamp")}
    # An unquoted nothing is NULL and "" is empty text; a mark of its own for NULL keeps Spark from merging the two.
    options |= {"lineSep": "\n", "nullValue": NULL_MARK}
    return spark.read.options(**options).option("mode", "FAILFAST").option("multiLine", str(multiline).lower()).schema(schema).csv(parts)
