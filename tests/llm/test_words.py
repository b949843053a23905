"""Spelling variants, language identification and ranked search against their
contracts, on edge cases and on a whole table."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import BENCH, TEXTS, bench, docs, given, none, table, wide  # noqa: F401

from tidewater.llm import language_crf, queries, ranked_search, spelling

SMALL = "/root/testdata/sf0.001"
key = repr


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


WORDS = ("word", "form", "root", "n", "n_near", "form_n")

#: Runs with insertions, deletions and replacements at every place, double
#: letters, ties, chains of forms, accents and two very long runs.
LONG = "q" * 60 + "u" * 40 + "abcdefghij" * 400
SPELT = ([(1, "colours " * 2000 + "colourss " * 150 + "colourssx " * 12 + "colour colourz colourz " * 2)]
         + [(i, f"balloon baloon balllon ballon ballloon calloon balloona éballoon BALLOON b×lloon balloon{'n' * (i % 3)}") for i in range(2, 40)]
         + [(40, f"{LONG} {LONG} {LONG}x {LONG}x {LONG[1:]} {LONG[:-1]}y {LONG[:-1]}y {LONG[1:]}"), (41, "aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa aaaaaab aaaaaab")])


def test_spelling(spark, docs, wide, none, given):
    spelt = table(spark, SPELT)
    want = sorted(brute.spelling(SPELT), key=key)
    assert any(w != r and f != r for w, f, r, *_ in want if f) and any(len(w) > 4000 and n for w, *_, n, _ in want)
    assert got(spelling.variants(spelt), *WORDS) == want
    for df, rows in ((docs, TEXTS), (wide, TEXTS), given):
        assert got(spelling.variants(df), *WORDS) == sorted(brute.spelling(rows), key=key)
    assert spelling.variants(none).collect() == []


def test_long_keys_by_sums_are_those_by_text(given):
    words = spelling.corpus_words(given[0])
    names = ("word", "n_near", "near_n", "near_word")
    assert got(spelling.near_words(words, limit=7), *names) == got(spelling.near_words(words), *names) != []


def test_groups_stay_small(spark):
    """A frequent key holds at most a row per letter, however many words."""
    rows = [(w, 2) for w in {f"abc{a}{b}efgh" for a in "abcdefghij" for b in "abcdefghij"}]
    keys = spelling._text_keys(spark.createDataFrame(rows, "word string, n long"), spelling.TEXT_KEY)
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] <= 11


def test_ranked_search(spark, docs, wide, none, bench, given):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    pairs = [(r.item_id, r.text) for r in items.collect()]
    for df, rows, asked, own in ((docs, TEXTS, bench, BENCH), (wide, TEXTS, bench.withColumn("w", F.lit("clash")), BENCH), (*given, items, pairs)):
        want = sorted(brute.ranked(rows, own), key=key)
        for shard_bytes in (ranked_search.SHARD_BYTES, 20_000):
            found = ranked_search.search(ranked_search.build_index(df, shard_bytes), asked, query_block=7)
            assert got(found, "item_id", "rank", "doc_id", "score") == want
    assert ranked_search.search(ranked_search.build_index(none), bench).collect() == []
    assert ranked_search.search(ranked_search.build_index(docs), bench.filter("false")).collect() == []


def shard(texts, m_of=lambda n: 10 + 3 * n):
    import pyarrow as pa
    terms, df, heads, data, lengths = ranked_search.posting_lists(pa.array(texts, pa.string()))
    lists = {t.decode(): ranked_search._List(int(1000 * np.log((2 * len(texts) + 2) / (2 * n + 1))), h.as_py(), d.as_py(), m_of)
             for t, n, h, d in zip(terms.to_pylist(), df, heads, data)}
    return lists, m_of(lengths)


def test_blocks_are_rejected_without_unpacking():
    """Common lists of a long shard are unpacked only where candidates are."""
    r = random.Random(5)
    texts = [" ".join(["the"] * r.randint(0, 3) + ["of"] * (i % 2) + r.choices(["rare", "seldom", "other", "more"], [1, 1, 2000, 2000], k=4))
             for i in range(20_000)]
    lists, m = shard(texts)
    asked = [lists[t] for t in ("the", "of", "rare", "seldom")]
    rank = np.arange(len(m))
    place, score = ranked_search.best_documents(asked, m, 10, rank)
    full = np.zeros(len(m), np.int64)
    for own in asked:
        docs_, gains = own.blocks(range(len(own.last)), m)
        full[docs_] += gains
    want = np.lexsort((rank, -full))[:10]
    assert place.tolist() == want.tolist() and score.tolist() == full[want].tolist()
    lists, m = shard(texts)
    asked = [lists[t] for t in ("the", "of", "rare", "seldom")]
    ranked_search.best_documents(asked, m, 10, rank)
    assert len(lists["the"].kept) < len(lists["the"].last) // 2


@pytest.mark.parametrize("texts", [[], [None, "", " "], ["a " * 70_000 + "b"], [f"w{i % 300} x" for i in range(70_000)]])
def test_posting_lists_round_trip(texts):
    lists, m = shard(texts)
    back = {t: dict(zip(*(x.tolist() for x in own.blocks(range(len(own.last)), m)))) for t, own in lists.items()}
    want = {}
    for i, t in enumerate(texts):
        for term in set((t or "").split()):
            tf = t.split().count(term) if len(t) < 100 else t.count(term)
            want.setdefault(term, {})[i] = ranked_search._gain(lists[term].weight, np.int64(tf), m[i])
    assert back == want


def test_forward_backward_is_exact():
    r = np.random.default_rng(4)
    first = np.array([0, 0, 6, 90, 91, 91, 400])
    scores, moves = r.normal(size=(400, 3)) * 4, r.normal(size=(3, 3)) * 2
    whole = language_crf.marginals(scores, first, moves, segment=1000)
    assert np.allclose(language_crf.marginals(scores, first, moves, segment=7), whole)
    assert np.allclose(whole[:6], brute.chain(scores[:6], moves))
    assert np.allclose(whole[90:91], brute.chain(scores[90:91], moves))
    assert language_crf.marginals(scores[:0], np.array([0, 0]), moves).shape == (0, 3)


def test_gradient_of_pairs():
    r = np.random.default_rng(6)
    first = np.array([0, 4, 9])
    scores, moves = r.normal(size=(9, 2)), r.normal(size=(2, 2))
    likely = language_crf.marginals(scores, first, moves)
    inner = np.ones(9, bool)
    inner[first[:-1]] = False
    pairs = language_crf._pair_sums(scores, first, likely, inner, moves)
    assert np.isclose(pairs.sum(), 7) and np.allclose(pairs.sum(0), likely[inner].sum(0))


@pytest.fixture(scope="module")
def model(spark):
    return language_crf.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_language_of_held_out_texts(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_crf.predict(df, model).join(df.select("doc_id", "lang"), "doc_id")
    out = found.filter("held_out").groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score"), F.max("score"))
    for r in out.collect():
        assert r.right >= 0.98 and 0 <= r[2] <= r[3] <= 1
    assert found.count() == df.count()


def test_language_of_words_in_mixed_text(spark, model):
    """Half of a document of one language and half of one of another, neither
    learnt from: words get their own half's language."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(~language_crf.training("doc_id"))
    by = {r.lang: r.text for r in df.groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    names, right, total = sorted(by), 0, 0
    for a, b in zip(names, names[1:] + names[:1]):
        left, more = by[a][:3000], by[b][:3000]
        labelled = language_crf.word_languages(left + "\n" + more, model)
        n = len(language_crf.word_languages(left, model))
        want = [a] * n + [b] * (len(labelled) - n)
        right += sum(got_ == w for (_, got_, _), w in zip(labelled, want))
        total += len(want)
    assert right / total > 0.95


def test_language_edge_cases(spark, docs, wide, none, model):
    rows = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    for df in (docs, wide):
        out = language_crf.predict(df, model).collect()
        assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out)
        blank = {d for d, t in rows if not any(c.isalpha() for c in t or "")}
        for r in out:
            if r.doc_id in blank and r.doc_id is not None:
                assert (r.lang_pred, r.score) == ("und", 0)
        assert {r.lang_pred for r in out} <= {*model.languages, "und"}
    assert language_crf.predict(none, model).collect() == []
    nothing = language_crf.fit(none)
    assert {(r.lang_pred, r.score) for r in language_crf.predict(docs, nothing).collect()} == {("und", 0)}
    unlabelled = language_crf.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.languages == []


def test_language_reads_whole_texts_and_text_only(spark, model):
    rows = [(i, t) for i, t in enumerate(["le la " * 3 + "the of and with " * 90_000, "the of and with " * 3 + "le la eau que " * 90_000])]
    df = table(spark, rows)
    assert [r.lang_pred for r in language_crf.predict(df, model).orderBy("doc_id").collect()] == ["en", "fr"]
    moved = df.select((F.col("doc_id") + 77).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("zz").alias("source"))
    assert [r.lang_pred for r in language_crf.predict(moved, model).orderBy("doc_id").collect()] == ["en", "fr"]


def test_registered_queries(spark, given):
    rows = given[1]
    found = queries.QUERIES["op11_spelling_variants"](spark, SMALL)
    assert dict(found.dtypes) == dict(word="string", form="string", root="string", n="bigint", n_near="bigint", form_n="bigint")
    assert got(found, *WORDS) == sorted(brute.spelling(rows), key=key)
    found = queries.QUERIES["op12_language_id"](spark, SMALL)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    import zlib
    assert {(r.doc_id, r.held_out) for r in found.collect()} == {(d, zlib.crc32(str(d).encode()) % 3 == 1) for d, _ in rows}
    found = queries.QUERIES["op13_ranked_search"](spark, SMALL)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert got(found, "item_id", "rank", "doc_id", "score") == sorted(brute.ranked(rows, [(r.item_id, r.text) for r in items.collect()]), key=key)
