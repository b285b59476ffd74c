from __future__ import annotations

import pytest

import corpus_pipeline
from sedimenta.llm import text as arrow_text
from sedimenta.llm.staging import discard, stage_lean

from .cases import DOCS, clashing, frame, odd_rows, prose
from .test_jaccard import plain as plain_components
from .test_repeats import plain as plain_repeats

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "suffix-array dedup", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]


@pytest.mark.parametrize("rows", [None, []], ids=["odd", "empty"])
def test_stages_keep_the_columns(spark, rows):
    docs = clashing(frame(spark, rows), "kept", "id", "topic", "spans")
    for name, stage in corpus_pipeline.STAGES:
        out = stage_lean(stage(spark, docs, SF), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "text"]
    assert rows is None or docs.count() == 0


def test_one_of_each_group_stays(spark):
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, frame(spark), SF).collect())
    found = plain_components([r[:2] for r in odd_rows()])
    assert kept == sorted({i for i, _, component in found if i == component})


def test_repeated_rows_of_one_document_leave_one(spark):
    rows = [(3, "a b c d e f g", "en", "s", 1)] * 3 + [(None, "a b c d e f g", "en", "s", 1), (None, "other", "en", "s", 1)]
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), SF).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, "other"), (3, "a b c d e f g")]


def test_passages_are_removed_and_characters_stay_whole(spark):
    text = "é" * 30 + prose(4, 60) + "é" * 100
    rows = [(1, text, "fr", "s", len(text)), (2, "x" + text[20:], "fr", "s", 1), (3, "short", "fr", "s", 5)]
    out = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, frame(spark, rows), SF).collect()}
    left = {i: kept for i, _, _, _, kept in plain_repeats([r[:2] for r in rows])}
    for i, r in out.items():
        assert r.text == left[i].decode("utf-8", "ignore") and r.n_chars == (len(r.text) if i != 3 else 5)


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and all(r.n_tokens == len(r.ids) for r in out)


def test_encoding_and_decoding_are_not_in_one_task(spark):
    plan = corpus_pipeline.encoding(spark, frame(spark), SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_workers_give_memory_back_at_the_end_of_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(arrow_text, "_give_back", lambda: calls.append(1))
    batches = arrow_text.tidy(lambda some: (x for x in some))(iter([1, 2]))
    assert [(x, len(calls)) for x in batches] == [(1, 0), (2, 0)] and calls == [1]


def test_discard_deletes_what_was_staged(spark):
    staged = stage_lean(frame(spark), "gone")
    assert staged.count() == len(odd_rows()) and DOCS
    discard(staged)
    with pytest.raises(Exception, match="exist"):
        spark.read.parquet(staged.staged_at)
