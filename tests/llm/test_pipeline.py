"""The stages of the corpus pipeline against brute force, each on its own input."""

import collections
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from edge_cases import CLASHES, ROWS, SCHEMA, edge_frame, no_rows
from shelfledger.llm import jaccard, languages
from shelfledger.llm.common import documents, written
from test_arrow_operators import check_pieces, plain_components, plain_spans
from test_native_operators import plain_targets

STAGES = dict(corpus_pipeline.STAGES)
KINDS = ("EMAIL", "IP", "CARD", "PHONE")


@pytest.fixture(scope="module")
def outputs(spark, small):
    """What goes into each stage and what comes out."""
    docs, found = documents(spark, small), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, small), name)
        found[name] = (docs, after)
        docs = after
    return found


def test_language_keeps_texts_with_letters(outputs):
    before, after = outputs["language"]
    lettered = [r.doc_id for r in before.collect() if re.search(r"[^\W\d_]", r.text or "")]
    assert sorted(r.doc_id for r in after.collect()) == sorted(lettered)
    assert after.columns == before.columns


def test_language_without_labels_keeps_texts(spark, small):
    docs = documents(spark, small).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.where("doc_id < 20")
    lettered = [r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")]
    kept = STAGES["language"](spark, docs, small).collect()
    assert lettered and sorted(r.doc_id for r in kept) == sorted(lettered)
    assert {r.lang for r in kept} == {"und"}


def test_sure_predictions_correct_wrong_labels(spark, small):
    docs = documents(spark, small.replace("sf0.001", "sf0.01")).where("n_chars > 500")
    stated = {r.doc_id: r.lang for r in docs.collect()}
    wrong = F.when(F.col("doc_id") % 25 == 0, F.when(F.col("lang") == "fr", "de").otherwise("fr"))
    after = STAGES["language"](spark, docs.withColumn("lang", F.coalesce(wrong, "lang")), small)
    found = {r.doc_id: r.lang for r in after.collect()}
    corrected = [found[d] == stated[d] for d in found if d % 25 == 0]
    unharmed = [found[d] == stated[d] for d in found if d % 25]
    assert sum(corrected) >= 0.3 * len(corrected) and sum(unharmed) >= 0.98 * len(unharmed)


def test_one_document_of_each_group_stays(outputs):
    before, after = outputs["near_duplicates"]
    docs = [(r.doc_id, r.text) for r in before.collect()]
    groups = plain_components(docs, jaccard.Likeness(5, 80, 100))
    kept = {least for _, n, least in groups}
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)
    assert after.exceptAll(before).isEmpty() and len(kept) < len(docs)


def test_personal_data_is_masked(outputs):
    before, after = outputs["personal_data"]
    masked = {r.doc_id: r for r in after.collect()}
    assert len(masked) == before.count()
    for r in before.collect():
        text, done, out = r.text, 0, ""
        for start, back, kind in sorted((a, -b, k) for k, a, b in plain_spans(text)):
            if -back > done:
                out += text[done:start] + f"[{KINDS[kind]}]" if start >= done else f"[{KINDS[kind]}]"
                done = -back
        assert masked[r.doc_id].text == out + text[done:]
        assert masked[r.doc_id].n_chars == len(masked[r.doc_id].text)


def test_mixture_meets_targets(outputs):
    before, after = outputs["mixture"]
    sizes, taken = collections.Counter(), collections.Counter()
    for r in before.collect():
        sizes[r.source] += len(r.text.split())
    for r in after.collect():
        taken[r.source] += len(r.text.split())
    targets = plain_targets(dict(sizes))
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= 0.1 * sizes[source]
    assert after.distinct().exceptAll(before.distinct()).isEmpty()


def test_packing_holds_every_document(outputs):
    before, after = outputs["packing"]
    from shelfledger.llm import packing

    once = before.dropDuplicates(["doc_id"])
    check_pieces(packing.pack(once).collect(), [(r.doc_id, r.text) for r in once.collect()])
    starts = after.filter("start = 0").count()
    assert starts == before.count()
    assert after.agg(F.sum("length")).first()[0] == after.filter("start = 0").agg(
        F.sum("doc_tokens")).first()[0]


def test_stages_take_edge_cases(spark):
    for frame, n in ((edge_frame(spark), len(ROWS)), (no_rows(spark), 0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, frame, "")
            assert name == "packing" or after.columns == frame.columns
            assert (after.count() > 0) == (n > 0)


def test_order_of_stages():
    assert list(STAGES) == ["language", "near_duplicates", "personal_data", "mixture", "packing"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_further_columns_stay_as_they_are(spark, small, name):
    """Whatever they are called, also like those that operators use inside."""
    docs = edge_frame(spark)
    after = STAGES[name](spark, docs, small)
    assert after.columns == docs.columns
    rows = after.collect()
    assert rows and all(
        tuple(r)[-len(CLASHES):] == tuple(f"c {i}" for i in range(len(CLASHES))) for r in rows)


def test_numbers_in_the_form_of_letters_are_no_language(spark, small):
    docs = spark.createDataFrame(
        [(1, "½ ² Ⅷ 12", "en", "a", 9), (2, "½ é", "en", "a", 3)], SCHEMA)
    assert [r.doc_id for r in STAGES["language"](spark, docs, small).collect()] == [2]
    texts = pa.array(["½ ² Ⅷ 12", None, ""])
    assert languages.predict_texts(languages.learn(documents(spark, small)), texts) == (
        ["und"] * 3, [0.0] * 3)
