"""Pipeline stages on columns that are named like their own, and on empty tables."""

import pytest

import corpus_pipeline as P
from cartwise.llm import decontaminate, repeats, simhash

NAMES = ["kept", "_id", "_sha", "_row", "_candidates", "_contamination", "kept_hash", "words", "item", "fp", "root", "KEPT_HASH_"]
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
TEXTS = ["alpha beta gamma delta " * 9, "alpha beta gamma delta " * 9, PASSAGE + " and then some more words", "quite another text of no interest to anyone at all", None]


def frame(spark, n_chars=True, rows=TEXTS):
    schema = "doc_id long, text string, lang string, source string" + (", n_chars long" if n_chars else "") + "".join(f", `{c}` string" for c in NAMES)
    return spark.createDataFrame([(i, t, "en", "s", *([len(t or "")] if n_chars else []), *(f"{c}{i}" for c in NAMES)) for i, t in enumerate(rows)], schema)


def stages(spark, docs):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    return [simhash.one_per_group(docs), repeats.without_repeats(docs), decontaminate.without_contaminated(docs, items),
            P.identify_language(spark, docs, "")]


@pytest.mark.parametrize("n_chars", [True, False])
def test_columns_pass_through_whatever_their_names(spark, n_chars):
    docs = frame(spark, n_chars)
    given = {r.doc_id: r.asDict() for r in docs.collect()}
    for out, left in zip(stages(spark, docs), [{0, 2, 3, 4}, {0, 2, 3, 4}, {0, 1, 3, 4}, {0, 1, 2, 3}], strict=True):
        rows = {r.doc_id: r.asDict() for r in out.collect()}
        assert out.columns == docs.columns and set(rows) == left
        assert all(rows[i][c] == given[i][c] for i in rows for c in [*NAMES, "lang", "source"])


@pytest.mark.parametrize("n_chars", [True, False])
def test_empty_tables_stay_empty(spark, n_chars):
    docs = frame(spark, n_chars, [])
    for out in stages(spark, docs):
        assert out.columns == docs.columns and out.count() == 0
