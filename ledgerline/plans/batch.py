"""The staged batch run: land -> clean -> dedup -> fusion -> snapshot -> figures -> report.

Each stage table is written once as a new version of ``<output_root>/stages/<name>``
(``sources.versions``: a rerun that dies leaves the tables of the run before) and
the next stage reads it back. That cuts lineage (a lost executor recomputes
at most one stage, from files on shared storage), and every later figure reads
a materialised table instead of recomputing the chain. Quality rules run after
each stage, and a failed rule stops the run there: no later stage is computed
and nothing is published.

Roots are any Hadoop URI (``s3a://``, ``abfss://``, ``hdfs://``, ``file:``);
executors read and write them directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import clean, metrics, quality, report
from ledgerline.plans import chain as C
from ledgerline.plans import reporting
from ledgerline.sources import files, schemas, snapshots, versions
from ledgerline.sources import tables as T


@dataclass
class BatchResult:
    stages: dict[str, str] = field(default_factory=dict)
    published: dict[str, str] = field(default_factory=dict)
    snapshot: dict[str, str] = field(default_factory=dict)
    checks: DataFrame | None = None
    report: DataFrame | None = None


class Stager:
    """Writes a stage once and hands back a DataFrame that reads the written files.

    ``put`` replaces the stage table at ``<root>/stages/<name>`` as a whole; ``paths``
    has the folder of the version that it wrote. ``put(..., bucket_by=key)`` writes
    the version as an external bucketed table (``buckets``, by default ``spark.sql.shuffle.partitions``). A
    dedup stage is already hash-partitioned that way by its aggregate, so the
    write adds no shuffle, and a later join of two stages bucketed on the join
    key reads both sides co-located: no exchange. Bucket only by a key that is
    unique in the stage: a bucketed read is not a shuffle, so a hot key of the
    other side could not be split. The table leaves the session catalog as soon
    as it is read; its files stay.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.paths: dict[str, str] = {}
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.run_id = uuid.uuid4().hex[:12]

    def put(self, name: str, df: DataFrame, bucket_by: str | None = None) -> DataFrame:
        root = f"{self.root}/stages/{name}"
        if bucket_by is None:
            self.paths[name] = versions.replace(df, root)
            return self.spark.read.schema(df.schema).parquet(self.paths[name])
        table = f"ledgerline_{self.run_id}_{name}"

        def bucketed(writer, path):
            writer.format("parquet").bucketBy(self.buckets, bucket_by).option("path", path).saveAsTable(table)

        try:
            self.paths[name] = versions.replace(df, root, bucketed)
            return self.spark.read.table(table)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: drops the entry, not the files

    def put_split(self, name: str, df: DataFrame, label_col: str) -> DataFrame:
        """A stage partitioned by a label, in one pass (``<version>/<label_col>=<value>/``)."""
        self.paths[name] = versions.replace(df, f"{self.root}/stages/{name}", lambda writer, path: writer.partitionBy(label_col).parquet(path))
        return self.spark.read.parquet(self.paths[name])

    def put_dedups(self, erp: DataFrame, web: DataFrame, link: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The dedup stages: master and link bucketed on the product (unique in both, so their join is co-located), posts as
        plain files, so the join on the link target is a shuffle join whose hot targets AQE splits."""
        return (
            self.put("erp_dedup", erp, bucket_by="product_id"),
            self.put("web_dedup", web),
            self.put("link_dedup", link, bucket_by="product_id"),
        )


def land_csv_sources(spark: SparkSession, input_root: str, single_line: Sequence[str] = ("erp", "liaison")) -> dict[str, DataFrame]:
    """Raw CSV drops ``<input_root>/{erp,web,liaison}.csv``: declared columns by header name, others as text.

    Sources in ``single_line`` have no quoted line breaks, so their files are split over tasks; a file of any other
    source is one task.
    """
    root = input_root.rstrip("/")
    return {
        name: schemas.land(files.read_csv_text(spark, f"{root}/{name}.csv", multiline=name not in single_line), name)
        for name in schemas.SCHEMAS
    }


def test_table_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three roles over the test tables (see ``ledgerline.sources.tables``)."""
    return {"erp": T.erp_raw(spark, sf_dir), "web": T.web_raw(spark, sf_dir), "liaison": T.link_raw(spark, sf_dir)}


class _Gate:
    """Evaluates the rules of a stage, writes them, and stops the run there if one failed."""

    def __init__(self, spark: SparkSession, root: str, stop: bool):
        self.spark, self.stop = spark, stop
        self.root = f"{root}/checks"  # one table, partitioned by stage
        versions.delete_folder(spark, self.root)  # the record is that of one run

    def check(self, stage: str, *results: DataFrame) -> None:
        path = f"{self.root}/stage={stage}"
        files.write_parquet(quality.union_results(results), path)
        if self.stop:
            quality.raise_on_failure(self.spark.read.parquet(path))

    def all(self) -> DataFrame:
        return self.spark.read.parquet(self.root)


def _drop_empty(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows, then columns, that hold nothing; a required column stays for the rules to report."""
    rows = clean.drop_empty_rows(df)
    counts = clean.non_null_counts(rows).first()
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if counts[c] > 0 or c in required])


def run_batch(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    output_root: str,
    expected: dict | None = None,
    rules: C.Rules = C.Rules(),
    zscore_source: tuple[DataFrame, str, list[str]] | None = None,
    raise_on_failure: bool = True,
    land_sources: bool = True,
    materialize_clean: bool = False,
) -> BatchResult:
    """Run stage after stage; each is checked before the next begins, and nothing is published unless all passed.

    ``sources``: raw ``erp``, ``web``, ``liaison`` DataFrames. ``rules``: column
    rules (``C.TEST_TABLE_RULES`` for the test tables). ``expected``: figures that
    the caller knows (``fused``, ``revenue_rows``, ``revenue_total``, ``outliers``);
    a figure that isn't given is reported with ``passed`` NULL. ``zscore_source``:
    ``(df, value_column, keep_columns)`` for the outlier split; defaults to the
    fused table's price.

    ``land_sources``: drop rows and columns that hold nothing, and write the raw
    sources once as Parquet (needed for CSV drops: parse once; pass False for
    sources that are already Parquet). ``materialize_clean``: also write the
    cleaned tables as stages. Off by default: they are map-only filters over
    durable files, so recomputing them is cheaper than a second full copy.
    """
    expected = expected or {}
    out = output_root.rstrip("/")
    st = Stager(spark, out)
    gate = _Gate(spark, out, raise_on_failure)
    res = BatchResult()

    # Landing: the raw tables, typed, once (CSV is parsed a single time).
    raw = dict(sources)
    if land_sources:
        required = {"erp": rules.erp_required, "web": rules.web_required, "liaison": rules.link_required}
        keep_always = {n: {*required[n], *(schemas.SCHEMAS[n].names)} for n in raw}
        landed = {n: st.put(f"{n}_raw", df) for n, df in raw.items()}
        raw = {n: _drop_empty(df, keep_always[n]) for n, df in landed.items()}
        gate.check("landing", *[quality.evaluate(df, f"{n}_raw", [quality.non_empty()]) for n, df in raw.items()])
    erp_raw, web_raw, link_raw = raw["erp"], raw["web"], raw["liaison"]

    erp_clean, web_clean, link_clean = C.clean_stage(erp_raw, web_raw, link_raw, rules)
    if materialize_clean:
        erp_clean = st.put("erp_clean", erp_clean)
        web_clean = st.put("web_clean", web_clean)
        link_clean = st.put("liaison_clean", link_clean)
    gate.check(
        "clean",
        quality.evaluate(erp_clean, "erp_clean", [quality.non_empty(), quality.not_null(rules.erp_required)]),
        quality.evaluate(web_clean, "web_clean", [quality.non_empty(), quality.not_null(rules.web_required)]),
        quality.evaluate(link_clean, "liaison_clean", [quality.non_empty(), quality.not_null(rules.link_required)]),
    )

    erp_dedup, web_dedup, link_dedup = st.put_dedups(*C.dedup_stage(erp_clean, web_clean, link_clean, rules))
    gate.check(
        "dedup",
        quality.evaluate(erp_dedup, "erp_dedup", [quality.non_empty(), quality.unique("product_id")]),
        quality.evaluate(web_dedup, "web_dedup", [quality.non_empty(), quality.unique("sku")]),
        quality.evaluate(link_dedup, "liaison_dedup", [quality.non_empty(), quality.unique("product_id")]),
    )

    fused_df, _, _ = C.figures_stage(erp_dedup, web_dedup, link_dedup, rules)
    fused = st.put("fusion", fused_df)
    gate.check(
        "fusion",
        quality.evaluate(fused, "fusion", [quality.row_count(expected.get("fused"))]),
        quality.columns_present(spark, fused, "fusion", ["product_id", "price", "stock_status", "post_title"]),
    )

    # Frozen copy of every table up to the fusion, with a manifest of digests, before any analytics.
    res.snapshot = snapshots.freeze(
        {
            "erp_clean": erp_clean, "web_clean": web_clean, "liaison_clean": link_clean,
            "erp_dedup": erp_dedup, "web_dedup": web_dedup, "liaison_dedup": link_dedup, "fusion": fused,
        },
        f"{out}/snapshots/after_fusion",
    )

    revenue = st.put("ca_par_produit", metrics.revenue_per_product(fused, instock_status=rules.instock_status))
    total = st.put("ca_total", metrics.revenue_total(revenue))
    gate.check(
        "revenue",
        quality.evaluate(
            revenue,
            "ca_par_produit",
            [
                quality.row_count(expected.get("revenue_rows")),
                quality.not_null(["product_id", "post_title", "price", "stock_quantity", "chiffre_affaires"]),
                quality.non_negative("chiffre_affaires"),
            ],
        ),
        quality.evaluate(total, "ca_total", [quality.amount_equals("ca_total", expected.get("revenue_total"))]),
    )

    if zscore_source is None:
        zdf, zval, zkeep = fused.select("product_id", "post_title", "price"), "price", ["product_id", "post_title", "price"]
    else:
        zdf, zval, zkeep = zscore_source
    classified = metrics.zscore_classify(zdf, zval, keep=zkeep)
    zscore = st.put_split("zscore", classified, "type")
    outliers = metrics.select_label(zscore, metrics.OUTLIER_LABEL)
    gate.check(
        "zscore",
        quality.evaluate(
            zscore.filter(F.col(zval).isNotNull()),
            "zscore",
            [quality.no_missing([zval, "z_score"]), quality.no_infinite([zval, "z_score"])],
        ),
        quality.evaluate(outliers, "outliers", [quality.row_count(expected.get("outliers"))]),
    )
    res.checks = gate.all()

    # Publish only after every rule passed.
    pub = f"{out}/published"
    tables = [
        ("erp_clean", erp_clean), ("web_clean", web_clean), ("liaison_clean", link_clean),
        ("fusion", fused), ("ca_par_produit", revenue), ("ca_total", total),
    ]
    for name, df in tables:
        files.write_csv(df, f"{pub}/{name}")
        res.published[name] = f"{pub}/{name}"
    for label, name in [(metrics.OUTLIER_LABEL, "outliers"), (metrics.ORDINARY_LABEL, "ordinary")]:
        files.write_csv(metrics.select_label(zscore, label), f"{pub}/{name}")
        res.published[name] = f"{pub}/{name}"

    keep = rules.keep_predicates()
    product = F.col("post_type") == F.lit(rules.product_post_type)
    counts = [
        report.stage_counts(erp_raw, keep["erp"], "product_id"),
        report.stage_counts(web_raw, keep["web"], "sku", product),
        report.stage_counts(link_raw, keep["liaison"], "product_id"),
    ]
    summary = report.clean_summary(
        [("erp", erp_raw, keep["erp"]), ("web", web_raw, keep["web"]), ("liaison", link_raw, keep["liaison"])]
    )
    files.write_csv(summary, f"{pub}/resume_stats")
    res.published["resume_stats"] = f"{pub}/resume_stats"

    rep = st.put("rapport_final", reporting.stage_report(counts, fused, rules.instock_status, outliers, expected))
    files.write_csv(rep.orderBy("step_no"), f"{pub}/rapport_final")
    res.published["rapport_final"] = f"{pub}/rapport_final"
    res.report = rep
    res.stages = dict(st.paths)
    return res
