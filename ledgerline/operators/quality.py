"""Data-quality rules evaluated in one aggregate pass per table.

A rule is an aggregate expression (its *actual* value) plus a test of that
value. ``evaluate`` puts every rule of one table into a single ``agg`` (one
scan, partial aggregation, a one-row result) and unpivots it to one row per
rule: ``rule, table_name, subject, actual, expected, passed``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.numeric import exact_sum

RESULT_SCHEMA = "rule string, table_name string, subject string, actual double, expected string, passed boolean"


class DataQualityError(RuntimeError):
    """Raised when at least one rule fails; stops the run before anything is published."""


@dataclass(frozen=True)
class Rule:
    rule: str
    subject: str
    actual: Callable[[], Column]
    expected: str
    check: Callable[[Column], Column] | None  # None: reported only, passed is NULL
    distinct: bool = False  # the aggregate is a COUNT(DISTINCT ...)


def _any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def non_empty() -> Rule:
    return Rule("non_empty", "*", lambda: F.count(F.lit(1)), "> 0", lambda a: a > F.lit(0))


def not_null(cols: Sequence[str], where: Column | None = None) -> Rule:
    """Rows with a NULL in any of ``cols``, among the rows that meet ``where``."""
    cols = list(cols)

    def actual() -> Column:
        return F.count_if(_any_null(cols) if where is None else where & _any_null(cols))

    return Rule("not_null", ",".join(cols), actual, "= 0", lambda a: a == F.lit(0))


def counted(name: str, column: str) -> Rule:
    """A count that is already a column of a one-row table."""
    return Rule(name, "*", lambda: F.max(F.col(column)), "> 0" if name == "non_empty" else "", (lambda a: a > F.lit(0)) if name == "non_empty" else None)


def unique(key: str) -> Rule:
    """Rows minus distinct non-NULL keys: NULL keys count as duplicates."""
    return Rule(
        "unique",
        key,
        lambda: F.count(F.lit(1)) - F.count_distinct(F.col(key)),
        "= 0",
        lambda a: a == F.lit(0),
        distinct=True,
    )


def row_count(expected: int | None) -> Rule:
    if expected is None:
        return Rule("row_count", "*", lambda: F.count(F.lit(1)), "", None)
    return Rule("row_count", "*", lambda: F.count(F.lit(1)), f"= {expected}", lambda a: a == F.lit(expected))


def amount_equals(col: str, expected: float | str | None, places: int = 2) -> Rule:
    """Exact amount at ``places`` decimals (summed over the table, NULL if empty)."""
    if expected is None:
        return Rule("amount", col, lambda: exact_sum(col, places=places, precision=38), "", None)
    target = Decimal(str(expected)).quantize(Decimal(1).scaleb(-places))
    dec = f"decimal(38,{places})"
    return Rule(
        "amount",
        col,
        lambda: exact_sum(col, places=places, precision=38),
        f"= {target}",
        lambda a: F.coalesce(a.cast(dec) == F.lit(target).cast(dec), F.lit(False)),
    )


def non_negative(col: str) -> Rule:
    return Rule("non_negative", col, lambda: F.count_if(F.col(col) < F.lit(0)), "= 0", lambda a: a == F.lit(0))


def no_missing(cols: Sequence[str]) -> Rule:
    """No NULL and no NaN in any of ``cols`` (count summed over the columns)."""
    cols = list(cols)

    def actual() -> Column:
        parts = [F.count_if(F.col(c).isNull() | F.isnan(F.col(c))) for c in cols]
        return reduce(lambda a, b: a + b, parts)

    return Rule("no_missing", ",".join(cols), actual, "= 0", lambda a: a == F.lit(0))


def no_infinite(cols: Sequence[str]) -> Rule:
    cols = list(cols)
    inf = F.lit(float("inf"))

    def actual() -> Column:
        parts = [F.count_if(F.abs(F.col(c)) == inf) for c in cols]
        return reduce(lambda a, b: a + b, parts)

    return Rule("no_infinite", ",".join(cols), actual, "= 0", lambda a: a == F.lit(0))


def _result_rows(one: DataFrame, table_name: str, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    return _rows(one, [(i, table_name, r) for i, r in rules])


def _rows(one: DataFrame, rules: Sequence[tuple[int, str, Rule]]) -> DataFrame:
    rows = []
    for i, table_name, r in rules:
        a = F.col(f"__a{i}")
        passed = r.check(a) if r.check is not None else F.lit(None).cast("boolean")
        rows.append(
            F.struct(
                F.lit(r.rule).alias("rule"),
                F.lit(table_name).alias("table_name"),
                F.lit(r.subject).alias("subject"),
                a.cast("double").alias("actual"),
                F.lit(r.expected).alias("expected"),
                passed.alias("passed"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def evaluate(df: DataFrame, table_name: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules on one table in one aggregate job; one output row per rule.

    Exception: a second ``COUNT(DISTINCT)`` on another key would make Spark
    duplicate every row once per key (Expand) before the shuffle, so each extra
    distinct rule gets its own aggregate pass instead.
    """
    if not rules:
        raise ValueError(f"no rules to evaluate on {table_name}")
    indexed = list(enumerate(rules))
    distinct = [(i, r) for i, r in indexed if r.distinct]
    shared = [(i, r) for i, r in indexed if not r.distinct] + distinct[:1]
    passes = [sorted(shared, key=lambda x: x[0])] + [[d] for d in distinct[1:]]
    parts = []
    for group in passes:
        one = df.agg(*[r.actual().alias(f"__a{i}") for i, r in group])
        parts.append(_result_rows(one, table_name, group))
    return union_results(parts)


def counts_table(df: DataFrame, rules: dict[str, Sequence[Rule]]) -> DataFrame:
    """Rules of several (logical) tables that one pass over ``df`` can answer; keys are the table names to report."""
    flat = [(table, r) for table, own in rules.items() for r in own]
    one = df.agg(*[r.actual().alias(f"__a{i}") for i, (_, r) in enumerate(flat)])
    return _rows(one, [(i, table, r) for i, (table, r) in enumerate(flat)])


def columns_present(spark: SparkSession, df: DataFrame, table_name: str, names: Sequence[str]) -> DataFrame:
    """One row per required column: 1.0 when the schema has it. Reads metadata only."""
    have = set(df.columns)
    data = [("column_present", table_name, n, 1.0 if n in have else 0.0, "= 1", n in have) for n in names]
    return spark.createDataFrame(data, RESULT_SCHEMA)


def compare(results: DataFrame, wanted: DataFrame) -> DataFrame:
    """Fill in the expected figures of ``results`` from a second computation.

    ``wanted``: ``rule, table_name, places, value`` (``places`` decimals count). A rule without a wanted figure keeps
    ``passed`` as it is. Both sides have one row per rule.
    """
    w = wanted.select(F.col("rule").alias("w_rule"), F.col("table_name").alias("w_table"), "places", F.col("value").alias("w_value"))
    both = results.join(w, (F.col("rule") == F.col("w_rule")) & (F.col("table_name") == F.col("w_table")), "left")
    exact = F.when(F.col("places") == 0, F.col("w_value").cast("decimal(38,0)").cast("string")).otherwise(F.col("w_value").cast("decimal(38,2)").cast("string"))
    known = F.col("w_rule").isNotNull()
    same = F.coalesce(F.round("actual", 2).cast("decimal(38,2)") == F.col("w_value").cast("decimal(38,2)"), F.lit(False))
    return both.select(
        "rule", "table_name", "subject", "actual",
        F.when(known, F.concat(F.lit("= "), exact)).otherwise(F.col("expected")).alias("expected"),
        F.when(known, same).otherwise(F.col("passed")).alias("passed"),
    )


def union_results(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), results)


def failures(results: DataFrame) -> list:
    """Failed rules (the result has one row per rule, so this is tiny)."""
    return results.filter(F.col("passed") == F.lit(False)).collect()


def assert_passed(results: DataFrame) -> DataFrame:
    """In-plan form of the stop rule: a lazy DataFrame (one row per rule) whose
    execution fails the job, with the rule named, as soon as a rule has failed.
    Nothing is collected to the driver; the check runs where it is executed."""
    msg = F.concat_ws(
        "",
        F.lit("data-quality rule failed: "),
        F.col("table_name"), F.lit("."), F.col("rule"), F.lit("("), F.col("subject"), F.lit(") actual "),
        F.coalesce(F.col("actual").cast("string"), F.lit("NULL")), F.lit(", expected "), F.col("expected"),
    )
    # As a filter predicate (always true when it returns), so pruning cannot drop it.
    return results.filter(F.assert_true(F.col("passed"), msg).isNull())


def raise_on_failure(results: DataFrame) -> None:
    bad = failures(results)
    if bad:
        lines = [
            f"{r['table_name']}.{r['rule']}({r['subject']}): actual {r['actual']}, expected {r['expected']}" for r in bad
        ]
        raise DataQualityError("data-quality rules failed:\n  " + "\n  ".join(lines))
