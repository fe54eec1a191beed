"""Tables that are created or replaced as a whole.

A table is a folder of versions and a folder of commits::

    <root>/v-<id>/...                 the Parquet files of one version
    <root>/_commits/<number>          the name of the version that became current

``replace`` writes a whole new version first and commits it last, by creating the next numbered commit file, which only one
writer can do. Readers take the highest commit that names a complete version. So a run that dies at any point leaves the
previous table as it was, a reader never meets half a table, and a table may be replaced by a query over itself.

Only the few names in ``_commits`` pass through the driver. Rows are written by the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer replaced the table since this one looked."""


class NoSuchVersion(LookupError):
    """The table has no committed version (or not the one asked for)."""


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    where, store = _folder(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    where, store = _folder(spark, path)
    store.delete(where, True)


def _commit_text(spark: SparkSession, root: str, name: str) -> str:
    where, store = _folder(spark, f"{root}/{COMMITS}/{name}")
    stream = store.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _whole(spark: SparkSession, path: str) -> bool:
    where, store = _folder(spark, f"{path}/_SUCCESS")
    return bool(store.exists(where))


def commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, line) of every commit, oldest first. A file that its writer did not finish has no line end; it is skipped."""
    root = root.rstrip("/")
    names = [n for n in children(spark, f"{root}/{COMMITS}") if n.isdigit()]
    lines = [(int(n), _commit_text(spark, root, n)) for n in names]
    return [(n, line.strip()) for n, line in lines if line.endswith("\n")]


def last_number(spark: SparkSession, root: str) -> int:
    """The highest commit number taken, by an unfinished commit too; 0 if none."""
    return max((int(n) for n in children(spark, f"{root.rstrip('/')}/{COMMITS}") if n.isdigit()), default=0)


def last_commit(spark: SparkSession, root: str) -> tuple[int, str]:
    """(number, line) of the newest finished commit; (0, '') if none. Opens no older one."""
    root = root.rstrip("/")
    for name in sorted((n for n in children(spark, f"{root}/{COMMITS}") if n.isdigit()), reverse=True):
        line = _commit_text(spark, root, name)
        if line.endswith("\n"):
            return int(name), line.strip()
    return 0, ""


def history(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version folder) of every commit that names a complete version, oldest first."""
    root = root.rstrip("/")
    return [(n, f"{root}/{line}") for n, line in commits(spark, root) if _whole(spark, f"{root}/{line}")]


def current_path(spark: SparkSession, root: str, version: int | None = None) -> str:
    """Folder of the current version, or of commit ``version``."""
    found = history(spark, root)
    if version is not None:
        found = [c for c in found if c[0] == version]
    if not found:
        raise NoSuchVersion(f"{root}: {'no committed version' if version is None else f'no commit {version}'}")
    return found[-1][1]


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current version (or commit ``version``). The frame stays on that version when the table is replaced later."""
    return spark.read.parquet(current_path(spark, root, version))


def commit(spark: SparkSession, root: str, number: int, line: str) -> None:
    """Create commit ``number`` with one line of text; ``CommitConflict`` if another writer has made it."""
    where, store = _folder(spark, f"{root}/{COMMITS}/{number:012d}")
    try:
        stream = store.create(where, False)  # fails if the number is taken
    except Exception as error:
        if store.exists(where):
            raise CommitConflict(f"{root}: commit {number} was made by another writer") from error
        raise
    stream.write(bytearray(f"{line}\n".encode()))
    stream.close()


def replace(df: DataFrame, root: str, write: Callable[[DataFrameWriter, str], None] | None = None, expect: int | None = None) -> str:
    """Write ``df`` as a new version of the table at ``root``, make it current, and return its folder.

    ``df`` may read the table that it replaces. ``write(writer, path)`` writes the version in another way than plain
    Parquet (bucketed, partitioned). The number of the commit is fixed before the version is written (or by ``expect``,
    the number of the commit that the caller read), so of two writers that overlap the second to finish gets
    ``CommitConflict``; its version is never visible, and ``vacuum`` removes it.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    number = (expect if expect is not None else last_number(spark, root)) + 1
    version = f"v-{uuid.uuid4().hex}"
    path = f"{root}/{version}"
    writer = df.write.mode("errorifexists")
    if write is None:
        writer.parquet(path)
    else:
        write(writer, path)
    if not _whole(spark, path):
        raise PySparkException(f"{path} was written without a success marker")
    commit(spark, root, number, version)
    return path


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete every version but those of the last ``keep`` commits, and return the names of what went.

    Not while a writer is at work: its version has no commit yet.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")
    root = root.rstrip("/")
    kept = {path.rsplit("/", 1)[1] for _, path in history(spark, root)[-keep:]}
    gone = [n for n in children(spark, root) if n.startswith("v-") and n not in kept]
    for name in gone:
        delete_folder(spark, f"{root}/{name}")
    return gone
