"""Land newly arrived raw CSV files into a typed Parquet table, exactly once.

The source work is a scheduled batch over files dropped under an input prefix.
As a file stream with ``Trigger.AvailableNow`` each scheduled run processes only
the files not yet landed, in bounded micro-batches, then stops. The checkpoint
records which files were committed, so a rerun after a lost executor or driver
neither skips nor duplicates a file. It belongs to the target, so it lies at a
fixed path beside it: every run of every application finds the same one.

``land_new_files`` runs only the stateless part (parse, type, normalise keys,
optionally the row-cleaning filter). ``dedup_new_files`` hands the same rows to a
deduplicated table that grows by new and changed keys only
(``operators.increments``); everything after it runs as the batch stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.increments import IncrementalDedup
from ledgerline.sources.files import CSV_OPTIONS, csv_header, text_schema
from ledgerline.sources.schemas import land


def checkpoint_of(target_path: str) -> str:
    """Where the landing into ``target_path`` keeps its progress."""
    return f"{target_path.rstrip('/')}__landing_checkpoint"


def land_new_files(
    spark: SparkSession,
    source_dir: str,
    target_path: str,
    source_name: str,
    checkpoint_path: str | None = None,
    keep: Column | None = None,
    max_files_per_trigger: int = 1000,
    wait: bool = True,
    multiline: bool = True,
) -> StreamingQuery:
    """Append the CSV files under ``source_dir`` not yet landed to ``target_path``.

    ``source_name`` (``erp``, ``web``, ``liaison``) selects the declared columns,
    which are matched by the header's names (see ``schemas.land``); ``keep`` is an
    optional row filter (e.g. the required-column rule). The checkpoint is
    ``checkpoint_of(target_path)`` unless another is named; a target keeps one
    checkpoint for good. ``multiline=False`` lets large files without quoted line
    breaks split.
    """
    ckpt = checkpoint_path or checkpoint_of(target_path)
    stream = _new_rows(spark, source_dir, source_name, keep, max_files_per_trigger, multiline)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start(target_path)
    )
    if wait:
        query.awaitTermination()
    return query


def dedup_new_files(
    spark: SparkSession,
    source_dir: str,
    table: IncrementalDedup,
    source_name: str,
    keep: Column | None = None,
    max_files_per_trigger: int = 1000,
    multiline: bool = True,
) -> StreamingQuery:
    """Absorb the CSV files under ``source_dir`` that ``table`` has not seen, and wait for the end.

    Arguments as for ``land_new_files``; progress is kept beside the table. A batch that is repeated after a lost driver
    changes nothing, since a rule's result is the same however often it sees a row. One such run at a time: an unfinished
    commit is taken for that of a run that died.
    """
    query = (
        _new_rows(spark, source_dir, source_name, keep, max_files_per_trigger, multiline)
        .writeStream.foreachBatch(lambda rows, _: table.absorb(rows, recover=True) and None)
        .option("checkpointLocation", checkpoint_of(table.root))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _new_rows(spark: SparkSession, source_dir: str, source_name: str, keep: Column | None, max_files: int, multiline: bool) -> DataFrame:
    stream = (
        spark.readStream.options(**CSV_OPTIONS)
        .option("multiLine", "true" if multiline else "false")
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", str(max_files))
        .schema(text_schema(csv_header(spark, source_dir)))
        .csv(source_dir)
    )
    stream = land(stream, source_name)
    return stream if keep is None else stream.filter(keep)
