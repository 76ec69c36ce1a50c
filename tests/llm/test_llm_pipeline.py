"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

import plain
from conftest import SMALL
from test_llm_operators import CLASHING, REPEATED, frame

import corpus_pipeline
from remitlens.llm import decontam, language, lines
from remitlens.llm.common import settle


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, before, SMALL), name)
        if name == "language_id":
            model = language.train(before.where(language.learnable()))
            good = language.identify(before, model).where("lang_pred <> 'und' and score >= 0.5")
            assert {d for d, _ in rows_of(after)} == {r.doc_id for r in good.collect()}
        elif name == "line_dedup":
            expected = [(d, t) for d, n, gone, t in plain.repeated_lines(rows_of(before), lines.RUN) if gone < n]
            assert sorted(rows_of(after)) == sorted(expected)
        elif name == "near_dedup":
            kept = [d for d, n, c in plain.near_components(rows_of(before), 5, 80, 100) if not n or c == d]
            assert sorted(d for d, _ in rows_of(after)) == sorted(kept)
        elif name == "decontamination":
            found = [t for _, t in rows_of(after) for i in items if decontam.plain(i) in decontam.plain(t)]
            lost = {d for d, _ in rows_of(before)} - {d for d, _ in rows_of(after)}
            assert not found and len(lost) >= sum(any(i in t for i in items) for _, t in rows_of(before)) > 0
        else:
            assert after.count() == before.count() and after.where("not round_trip").count() == 0
        if name != "sentencepiece":
            assert after.columns == docs.columns
        before = after
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, before.collect()))


def test_hostile_rows_pass_through(spark):
    docs = frame(spark, REPEATED)
    labelled = docs.withColumn("lang", docs.text.substr(1, 1))
    for name, stage in corpus_pipeline.STAGES[1:]:
        after = settle(stage(spark, labelled, SMALL), name)
        assert after.count() > 0
        if name != "sentencepiece":
            assert after.columns == ["doc_id", "text", *CLASHING, "lang"]
    empty = labelled.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
