"""The pipeline's stages, one after the other."""

import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline as pipeline
from strata.llm import bpe, langid
from tests.llm import brute
from tests.llm.test_operators import DOCS, SF_DIR, near_copies


def test_run(spark):
    result = pipeline.run(spark, SF_DIR)
    assert result.filter("not round_trip").count() == 0 and result.count() > 0


def test_stages_decide(spark):
    texts = [*near_copies(20), None, "", "12 34", "77 !"]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)
    kept = pipeline.language(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == set(range(80))
    one = pipeline.near_copies(spark, kept, "")
    expected = {root for _, root in brute.jaccard_classes(dict(enumerate(texts[:80]))).values()}
    assert {r.doc_id for r in one.collect()} == expected and one.count() == len(expected)
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
    twice = docs.filter("doc_id < 3").unionAll(docs.filter("doc_id < 3"))
    assert pipeline.near_copies(spark, twice, "").count() == 3


def test_languages_that_were_not_learned_go(spark):
    """Rejection does not depend on how many languages there are: other scripts and noise go, what was learned stays."""
    strange = ["Съешь же ещё этих мягких французских булок, да выпей чаю. Это простой текст.", "日本語のテキストです。今日は良い天気ですね。", "qzxj vbnk wqpz xkcd zzqv jjkw pqlm wvxz"]
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    n = given.count()
    odd = spark.createDataFrame([(10**6 + i, t, None, "s", len(t)) for i, t in enumerate(strange)], DOCS)
    kept = {r.doc_id for r in pipeline.language(spark, given.unionAll(odd), "").collect()}
    assert not kept & {10**6 + i for i in range(len(strange))}
    assert len(kept) == given.filter("text RLIKE '\\\\p{L}'").count() <= n


def test_null_ids_and_empty_tables(spark):
    """One row a group also without ids; an empty table goes through every stage."""
    one, two = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4).strip(), "north south east west up down left right in out " * 4
    texts = [one, one + " lambda", two, two + "over", "", one]
    docs = spark.createDataFrame([(None, t, "en", "s", len(t)) for t in texts] + [(7, one, "en", "s", len(one))], DOCS)
    kept = pipeline.near_copies(spark, docs, "").collect()
    assert len(kept) == 3 and 7 in {r.doc_id for r in kept} and "" in {r.text for r in kept}
    assert pipeline.tokens(spark, docs.limit(0), "").count() == 0


def test_near_copies_sort_the_texts_once(spark):
    """Copies of a row and all but one of a group go in one shuffle and one sort of the texts."""
    texts = near_copies(20)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] * 2, DOCS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = pipeline.near_copies(spark, docs, "")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        rows = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One of the texts, one of the ids that stay.
    assert plan.count("Sort [__key#") == 2
    expected = {root for _, root in brute.jaccard_classes(dict(enumerate(texts))).values()}
    assert sorted(r.doc_id for r in rows) == sorted(expected)


def test_one_copy_of_the_text_for_tokens(spark):
    """The text goes to Python once and does not come back; the flag is still that of the decoded ids."""
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(["a b", None, "", "é日 " * 9])], DOCS)
    coded = pipeline.tokens(spark, docs, "")
    assert coded.columns == ["doc_id", "lang", "source", "n_tokens", "tokens", "round_trip"]
    assert [r.round_trip for r in coded.orderBy("doc_id").collect()] == [True] * 4
    assert "decoded" not in coded._jdf.queryExecution().analyzed().toString()
    for kept in (("doc_id", "text"), ("doc_id",)):
        both = bpe.encode(docs, pipeline.VOCABULARY, ".", keep=kept, decoded=True, round_trip=True)
        assert "__text" not in both._jdf.queryExecution().analyzed().toString() or "text" not in kept
        for r in both.collect():
            assert (bytes(r.decoded) == (docs.filter(docs.doc_id == r.doc_id).first().text or "").encode()) == r.round_trip
    given = (np.frombuffer(b"abcd", np.uint8), np.array([0, 1, 1, 4]))
    assert bpe._same_rows(*given, np.frombuffer(b"abce", np.uint8), np.array([0, 1, 1, 4])) == [True, True, False]
    assert bpe._same_rows(*given, np.frombuffer(b"abcd", np.uint8), np.array([0, 0, 1, 4])) == [False, False, True]


def test_languages_of_a_large_batch_in_little_memory():
    """Memory follows one text's n-grams, not those of all texts of a batch."""
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 2000))) for _ in range(1000)]
    model = langid.Model(["en"], np.ones(langid.DIMENSIONS), np.zeros((langid.DIMENSIONS, 1), np.float32), np.zeros(1), 1.0)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    langid.counts("a")
    tracemalloc.start()
    rows = sum(part.num_rows for part in langid.judged(iter([batch]), model, "text", ["text"], True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 20e6
