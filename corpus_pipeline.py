"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, is written as Parquet and read
again.  Rows keep the columns of ``documents`` until the last stage.  Stages
decide row by row, so that rows without a doc_id, or of one doc_id with unlike
texts, are each judged by their own text.

A row is named by its place in its file while a stage judges it; verdicts come
back as bitmaps over places, so that no stage copies or shuffles the texts that
it keeps as they are.  Columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, packing, quality_rules, secret_scan, simhash
from tidewater.llm.common import read_table, stage
from tidewater.llm.queries import digest_pieces
from tidewater.llm.row_places import bitmaps, free_name, is_in, placed


def _named(columns: list[str], inside: str = "") -> list[Column]:
    """The columns of these names, of any spelling."""
    return [F.col(f"{inside}`{c.replace('`', '``')}`").alias(c) for c in columns]


class _Rows:
    """A stage's rows with their places."""

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.place, self.verdict = free_name(docs, "pipeline_place"), free_name(docs, "pipeline_verdict")
        self.rows = placed(docs, self.place)

    def named(self) -> DataFrame:
        """What operators see: a doc_id of its own for every row, and the text.
        Their order is that of the rows' doc_ids (a null is larger than any),
        then of the places."""
        own = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"),
                       F.col(f"{self.place}.file").alias("file"), F.col(f"{self.place}.at").alias("at"))
        return self.rows.select(own.alias("doc_id"), "text")

    def judged(self, found: DataFrame) -> DataFrame:
        """All rows, and whether ``found`` has their doc_id (as :meth:`named`)."""
        return is_in(self.rows, self.place, bitmaps(found, "doc_id"), self.verdict)

    def kept(self, found: DataFrame) -> DataFrame:
        """The rows whose doc_id ``found`` has."""
        return self.judged(found).where(F.col(self.verdict)).select(*_named(self.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = _Rows(docs)
    return rows.kept(quality_rules.judge(rows.named()).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the smallest doc_id (a
    null is larger than any), and of its rows the first."""
    rows = _Rows(docs)
    return rows.kept(simhash.near_duplicates(rows.named()).filter("doc_id = component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    rows = _Rows(docs)
    found = decontaminate.contamination(rows.named(), read_table(spark, sf_dir, "benchmark"))
    return rows.kept(found.filter(~F.col("contaminated")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every found secret masked in the text and n_chars to
    match.  Only the texts that hold one are joined with their findings."""
    rows = _Rows(docs)
    found = stage(secret_scan.scan(rows.named()).filter(F.size("spans") > 0).select("doc_id", "spans"), "pipeline-findings")
    judged = rows.judged(found)
    clean = judged.where(~F.col(rows.verdict)).select(*_named(rows.columns))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))
    changed = [c for c in docs.columns if c in ("text", "n_chars")]
    rest = [c for c in docs.columns if c not in changed]
    held = judged.where(F.col(rows.verdict)).select(F.col(rows.place).alias("doc_id"), *changed, F.struct(*_named(rest)).alias("rest"))
    by_place = found.select(F.struct(F.col("doc_id.file").alias("file"), F.col("doc_id.at").alias("at")).alias("doc_id"), "spans")
    masked = secret_scan.redact(held, by_place)
    back = [c for name in docs.columns for c in _named([name], "" if name in changed else "rest.")]
    return clean.unionByName(masked.select(*back))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return digest_pieces(packing.pack_documents(docs))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", pack)]

#: The quality posterior and the network's spans are not SQL; the first four
#: stages are tested one by one, and run() as a whole, in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
