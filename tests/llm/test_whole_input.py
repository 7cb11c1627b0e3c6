"""Operators that learn read all that they may learn from."""

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from martloom.llm import language
from martloom.llm.subwords import slices

DOCS = "doc_id long, text string, lang string"
WORDS = {"en": "the house and garden of our village", "fr": "la maison et le jardin de notre village"}


def labelled(spark):
    rows = [(i, f"{WORDS[lang]} {'qx' * 40 if i % 50 < 2 else ''} {i}", lang) for i, lang in enumerate(["en", "fr"] * 100)]
    return spark.createDataFrame(rows, DOCS)


def test_cutoffs_come_from_all_documents(spark):
    """they came from a sample, here of two documents a language."""
    docs = labelled(spark)
    model = language.fit(docs, F.lit(True), max_docs=8)
    for at, lang in enumerate(model.languages):
        texts = [r["text"] for r in docs.where(F.col("lang") == lang).collect()]
        steps, letters = [], []
        for part in slices(texts):
            found = language.likelihoods(part, language.gram_scores(part, model))[:, at]
            steps += np.floor(language.STEPS * found).astype(int).tolist()
            letters += (part.end - part.start).tolist()
        order = np.argsort(steps, kind="stable")
        below = np.cumsum(np.array(letters)[order])
        want = np.array(steps)[order][np.searchsorted(below, language.RARE * below[-1], "right")] / language.STEPS
        assert model.cutoffs[at] == want


def test_the_pipeline_learns_from_all_documents(spark, monkeypatch):
    """counts came from about 4,000 documents a language."""
    docs = labelled(spark)
    seen = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda *a, **b: seen.append(b) or fit(*a, **b))
    corpus_pipeline.keep_known_language(spark, docs, "").count()
    assert seen == [{"max_docs": None}]
    whole, most = fit(docs, F.lit(True), max_docs=None), fit(docs, F.lit(True), max_docs=10**9)
    assert (whole.weights == most.weights).all() and (whole.weights != fit(docs, F.lit(True), max_docs=8).weights).any()
