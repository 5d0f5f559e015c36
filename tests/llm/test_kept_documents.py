"""Which documents the pipeline's SimHash stage keeps."""

from cartwise.llm import simhash as S
from cartwise.llm.common import ship_package


def test_one_row_of_every_component_stays(spark):
    ship_package(spark)
    text = lambda word: " ".join(f"{word}{i}" for i in range(40))
    a, b, c, d, e = map(text, ("ant", "bee", "cat", "dog", "elk"))
    rows = [(None, a), (None, b), (None, b.upper()), (None, b),  # null ids: alone, and near and exact copies
            (7, c), (7, c.upper()), (9, c), (None, c),           # near copies under a repeated id
            (8, d), (8, d), (8, e)]                              # a repeated row, and an unlike text under its id
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text.lower()) for r in kept.collect()), key=repr) == sorted([(None, a), (None, b), (7, c), (8, d), (8, e)], key=repr)
