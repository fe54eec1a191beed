"""Deduplicated tables kept up to date as files arrive.

Each of the three dedup rules gives the same rows whether it sees all input at once or its own results of parts of it:
``rule(rule(a) + rule(b)) = rule(a + b)``, and seeing rows a second time changes nothing. So the state of a rule is a few
*runs*: Parquet folders that each hold the rule's result over the files of some runs of the job. ``absorb`` applies the rule
to new rows only and adds its result, the new and changed keys, as one more run. Old runs are read only when the new one has
at least half their rows; then they are merged into one. A table of n keys has O(log n) runs, and a key is rewritten
O(log n) times in its life, however many scheduled runs there are. ``read`` applies the rule over the runs.

A commit (a numbered file, as in ``sources.versions``) lists the runs. A run that dies leaves the commit before it in force,
and absorbing its files again is harmless, because the rules don't count. Only the short list of runs passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources import versions

Rule = Callable[[DataFrame], DataFrame]


class IncrementalDedup:
    """The table of one rule below ``root``.

    ``rule`` takes rows and returns at most one row per key with columns that it can take again (``max_per_key``,
    ``min_link`` with a fixed ordering, ``latest_per_key`` with tie breakers that decide). ``prepare`` runs on new rows
    only: filters and projections that the rule's results have behind them.
    """

    def __init__(self, spark: SparkSession, root: str, rule: Rule, prepare: Rule | None = None):
        self.spark, self.root, self.rule, self.prepare = spark, root.rstrip("/"), rule, prepare

    def runs(self) -> list[tuple[str, int]]:
        """Folder and rows of each run, oldest first; empty before the first commit."""
        return self._state()[1]

    def _state(self) -> tuple[int, list[tuple[str, int]]]:
        number, line = versions.last_commit(self.spark, self.root)
        return number, [(f"{self.root}/{name}", rows) for name, rows in json.loads(line or "[]")]

    def _frame(self, runs: list[tuple[str, int]]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(path) for path, _ in runs])

    def _write(self, df: DataFrame) -> tuple[str, int]:
        path = f"{self.root}/run-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
        return path, self.spark.read.parquet(path).count()  # from the footers

    def absorb(self, rows: DataFrame, recover: bool = False) -> int:
        """Take in new rows and return the number of keys that they hold.

        Of two overlapping calls the second to finish gets ``versions.CommitConflict``; it may be repeated. So does a call
        that finds an unfinished commit: its writer is at work, or died at that moment. ``recover`` passes over it; set it
        when no other writer can be left.
        """
        number, runs = self._state()
        newest = versions.last_number(self.spark, self.root)
        if newest > number and not recover:
            raise versions.CommitConflict(f"{self.root}: commit {newest} is unfinished")
        fresh = self._write(self.rule(rows if self.prepare is None else self.prepare(rows)))
        if fresh[1] == 0 and runs:
            return 0
        keep, total = list(runs), fresh[1]
        while keep and 2 * total >= keep[-1][1]:
            total += keep.pop()[1]
        merged = runs[len(keep) :]
        last = self._write(self.rule(self._frame([*merged, fresh]))) if merged else fresh
        listed = [(path.rsplit("/", 1)[1], n) for path, n in [*keep, last]]
        versions.commit(self.spark, self.root, newest + 1, json.dumps(listed))
        return fresh[1]

    def read(self) -> DataFrame:
        """The deduplicated table as of now; the frame stays on its runs when more is absorbed."""
        runs = self.runs()
        if not runs:
            raise versions.NoSuchVersion(f"{self.root}: nothing absorbed yet")
        return self._frame(runs) if len(runs) == 1 else self.rule(self._frame(runs))

    def vacuum(self) -> list[str]:
        """Delete runs that the newest commit doesn't list, and return their names. Not while ``absorb`` is at work."""
        listed = {path for path, _ in self.runs()}
        gone = [n for n in versions.children(self.spark, self.root) if n.startswith("run-") and f"{self.root}/{n}" not in listed]
        for name in gone:
            versions.delete_folder(self.spark, f"{self.root}/{name}")
        return gone
