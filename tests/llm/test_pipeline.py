"""The stages of the pipeline decide row by row."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from samples import TEXTS, docs, given, none, table, wide  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def odd(spark, given):  # noqa: F811
    """The smallest table, with ids that are null or stand for two texts."""
    rows = [(None if i % 7 == 0 else d // 2, t) for i, (d, t) in enumerate(given[1])]
    return table(spark, rows + TEXTS), rows + TEXTS


def test_quality_by_row(spark, odd):
    df, rows = odd
    alone = table(spark, list(enumerate(t for _, t in rows)))
    want = Counter(rows[d] for d, _ in kept(pipeline.quality(spark, alone, SMALL)))
    assert any(d is None for d, _ in want)
    assert kept(pipeline.quality(spark, df, SMALL)) == want


def test_near_duplicates_by_row(spark, odd):
    df, rows = odd
    component = [c for *_, c in brute.near(list(enumerate(t for _, t in rows)))]
    groups = defaultdict(list)
    for own, c in zip(rows, component, strict=True):
        groups[c].append(own)
    out = kept(pipeline.near_duplicates(spark, df, SMALL))
    assert sum(out.values()) == len(groups)
    order = lambda d: (d is None, d or 0)
    assert Counter(d for d, _ in out.elements()) == Counter(min((d for d, _ in own), key=order) for own in groups.values())
    assert not out - Counter(rows)


def test_decontamination_by_row(spark, odd):
    df, rows = odd
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = brute.contamination(rows, items)
    assert kept(pipeline.decontamination(spark, df, SMALL)) == Counter(own for own, f in zip(rows, found, strict=True) if not f[-1])


def test_secrets_by_row(spark):
    rows = [(1, "password: hunter2222"), (1, "plain words of the same id"), (None, "secret=abcdef12 x"), (None, None), (2, "")]
    out = pipeline.secrets(spark, table(spark, rows, extra=True), SMALL)
    assert out.columns == table(spark, rows, extra=True).columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in out.collect()) == Counter(
        [(1, "[SECRET]", 8), (1, rows[1][1], 26), (None, "[SECRET] x", 10), (None, None, None), (2, "", 0)])


def test_columns_of_any_name_pass(spark):
    rows = [(1, "password: hunter2222"), (2, "plain words")]
    df = table(spark, rows, extra=True)
    for name in ("pipeline_place", "pipeline_verdict", "rest", "file", "at", "a.b", "spans_"):
        df = df.withColumn(name, F.lit("clash"))
    for step in (pipeline.near_duplicates, pipeline.secrets):
        out = step(spark, df, SMALL)
        assert out.columns == df.columns and out.count() == 2


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Writes a documents table beside the given benchmark; returns its folder."""
    def write(df):
        at = str(tmp_path_factory.mktemp("tables"))
        df.write.parquet(f"{at}/documents.parquet")
        spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{at}/benchmark.parquet")
        return at
    return write


def test_whole_run(spark, given):
    """The packed pieces hold what the stages, one after the other, keep."""
    docs_ = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, step in pipeline.STAGES[:-1]:
        docs_ = step(spark, docs_, SMALL)
    want = Counter((r.doc_id, len(r.text)) for r in docs_.select("doc_id", "text").collect())
    assert 0 < sum(want.values()) < len(given[1])
    pieces = pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in pieces} == {d for d, _ in want}
    for d in {d for d, _ in want}:
        own = [r for r in pieces if r.doc_id == d]
        assert sum(r.length for r in own) == own[0].doc_tokens
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not {d for d, _ in want} & {d for d, *_, flagged in brute.contamination(given[1], items) if flagged}


def test_empty_and_clashing_run(spark, folder):
    empty = folder(table(spark, []))
    assert pipeline.run(spark, empty).collect() == []
    wide_ = table(spark, TEXTS, extra=True).withColumn("pipeline_place", F.lit("clash"))
    pieces = pipeline.run(spark, folder(wide_)).collect()
    assert pieces and {r.doc_id for r in pieces} <= {d for d, _ in TEXTS}
