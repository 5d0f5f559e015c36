"""Which documents the pipeline's language stage keeps."""

import numpy as np
import pytest

import corpus_pipeline as P
from cartwise.llm import language
from cartwise.llm.common import ship_package

SCHEMA = "doc_id long, text string, lang string"
TEXTS = ["the cat and the dog", "der hund und die katze", "12 34 !", "", None]


def test_an_unlabelled_corpus_is_kept(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(TEXTS)], SCHEMA)
    assert sorted(r.doc_id for r in P.identify_language(spark, docs, "").collect()) == [0, 1]


@pytest.mark.parametrize("lead, kept", [(0.0, []), (0.2, []), (1.0, [0, 1])])
def test_a_text_without_a_leading_language_goes(spark, monkeypatch, lead, kept):
    ship_package(spark)
    nothing = np.zeros(language.FEATURES), np.zeros((language.FEATURES, 4))
    monkeypatch.setattr(language, "train_on_documents", lambda docs: language.LanguageModel(("de", "en", "es", "fr"), *nothing, np.array([0.0, lead, 0.0, 0.0]), 1.0))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], SCHEMA)
    assert sorted(r.doc_id for r in P.identify_language(spark, docs, "").collect()) == kept


def test_a_text_torn_between_two_languages_stays(spark, monkeypatch):
    ship_package(spark)
    nothing = np.zeros(language.FEATURES), np.zeros((language.FEATURES, 4))
    monkeypatch.setattr(language, "train_on_documents", lambda docs: language.LanguageModel(("de", "en", "es", "fr"), *nothing, np.array([9.0, 9.0, 0.0, 0.0]), 1.0))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], SCHEMA)
    assert sorted(r.doc_id for r in P.identify_language(spark, docs, "").collect()) == [0, 1]
