"""Lexical search, exact top-k search and periodic runs against brute force and SQL, and on hard rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from cartwise.llm import exact_topk as X, lexical_search as S, periodic_runs as P, queries as L
from cartwise.llm.common import ship_package

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, query int, rank int, id long, bound long"


def docs_frame(spark, texts):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in texts], DOCS).repartition(3)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- lexical search ----------------------------------------------------------

def ranked(docs, items, k):
    terms = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (s or "").translate({c: c + 32 for c in range(65, 91)}))
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(d[2] for d in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda z: z[:2] + (z[2] or 0,))[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Ñandú", "日本", "the", "a1"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", ",", ".", "-x"]) for _ in range(n))
    same = text(40)
    texts = [None, "", " ,. ", "THE the The", text(6000), "the " * 5000] + [same] * 30 + [text(rng.randint(1, 80)) for _ in range(150)]
    rows = list(enumerate(texts))
    return rows + [rows[40], (None, same), (None, None)]


def test_search_equals_brute_force(spark, prose):
    items = [(1, prose[8][1]), (2, prose[60][1] + " the the"), (3, None), (4, "nowhere else"), (2, prose[60][1]), (None, "THE w1 w2"), (7, "日本")]
    asked = spark.createDataFrame([(i, t, 5, "z") for i, t in items], "item_id long, text string, doc_id int, score string")
    docs = docs_frame(spark, prose)
    assert bag(S.rank_documents(docs, asked)) == ranked(prose, items, 10)
    assert bag(S.rank_documents(docs, asked, k=1)) == ranked(prose, items, 1)


def test_search_groups_of_queries_and_narrow_signatures(spark, prose, monkeypatch):
    monkeypatch.setattr(S, "QUERY_BYTES", 60)
    items = [(i, prose[60 + i][1]) for i in range(6)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert bag(S.rank_documents(docs_frame(spark, prose), asked)) == ranked(prose, items, 10)


def test_search_of_nothing(spark, prose):
    docs = docs_frame(spark, prose)
    none, item = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert bag(S.rank_documents(none, item)) == bag(S.rank_documents(docs, item.where("false"))) == []
    assert bag(S.rank_documents(docs.where("text is null"), item)) == []


def test_bounds_are_never_below_scores(prose):
    """Of any document's signature, the levels shown are at least those of its occurrences."""
    for width in (64, 256):
        counts = Counter(S.terms_of((prose[4][1]).encode()))
        keys = [(S._hashes([t]), sum(n >= x for x in S.LEVELS)) for t, n in counts.items()]
        bits = np.zeros(width, bool)
        for h, levels in keys:
            for level in range(levels):
                bits[S._positions(h, level, width)] = True
        assert all(bits[S._positions(h, level, width)].all() for h, levels in keys for level in range(levels))


@pytest.mark.parametrize("name, tables", [("op11_lexical_search", ("documents", "benchmark")), ("op12_exact_topk", ("embeddings",))])
def test_query_equals_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = L.REGISTRY[name](spark, SF), con.sql(L.ORACLE_SQL[name])
    assert got.columns == want.columns and bag(got) == sorted(want.fetchall(), key=repr)


# -- exact top-k -------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, q int, c int, score string"


def vectors_frame(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, v, 1, 2, "s") for i, v in rows], VECTORS).repartition(3)


def products(rows, k):
    whole = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, v in whole:
        if i is None or i % 20:
            continue
        others = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for j, w in whole if j != i))[:k]
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(others)]
    return sorted(out, key=repr)


def test_top_products_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    vector = lambda n=6: [rng.randint(-96, 96) / 64 for _ in range(n)]
    common = vector()
    rows = [(i, common if i % 3 == 0 else vector()) for i in range(200)]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (220, []), (None, common), (None, vector()), (240, vector(3)),
             (20, vector()), (20, vector()), (40, rows[40][1]), rows[60]]
    for blocks in ((512, 8192), (3, 7)):
        monkeypatch.setattr(X, "QUERY_BLOCK", blocks[0])
        monkeypatch.setattr(X, "CANDIDATE_BLOCK", blocks[1])
        assert bag(X.top_products(vectors_frame(spark, rows))) == products(rows, 20)
    few = rows[:13]
    assert bag(X.top_products(vectors_frame(spark, few), k=15)) == products(few, 15)


def test_top_products_of_nothing_and_of_wide_numbers(spark):
    assert bag(X.top_products(vectors_frame(spark, []))) == []
    assert bag(X.top_products(vectors_frame(spark, [(0, [1.0])]))) == []
    assert X._kind(64, 511) == "f4" and X._kind(64, 512) == "f8" and X._kind(64, 1 << 25) == "i8"
    wide = [(0, [3e6, 1.0]), (1, [3e6, -2e6]), (2, [-3e6, 1.0]), (3, [0.0, 4e6])]
    assert bag(X.top_products(vectors_frame(spark, wide))) == products(wide, 20)
    with pytest.raises(ValueError):
        X.top_products(vectors_frame(spark, [(0, [1e9])]))


# -- periodic runs -----------------------------------------------------------

def plain_runs(w):
    out = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                out.setdefault((i, j + p - i), p)  # the smallest period comes first
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(0, 7)):
            n, letters = rng.choice([0, 1, 5, 6, 7, 12, 40, 150]), rng.choice([1, 2, 2, 3, 5])
            w = [bytes([97 + rng.randrange(letters)]) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w = w[:a] + [w[a + i % p] for i in range(n - a)]
            texts.append(list(rng.choice(texts)) + w if texts and rng.random() < 0.3 else w)
        assert P.runs_of_texts(texts) == [plain_runs(w) for w in texts]


def test_runs_of_long_texts():
    assert P.runs_of_texts([[b"a"] * 100_000, [b"a", b"b"] * 50_000 + [b"c"] * 7]) == [[(0, 100_000, 1)], [(0, 100_000, 2), (100_000, 7, 1)]]
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(18):
        a, b = b, b + a
    assert P.runs_of_texts([b, b"x y z".split()]) == [[], []]  # Fibonacci words hold no fourth power


def test_grammar_derives_its_texts():
    rng = random.Random(4)
    x = np.array([rng.randrange(3) for _ in range(500)])
    text = np.sort(np.array([rng.randrange(6) for _ in range(500)]))
    g = P.Grammar(x.copy(), text)

    def derive(s):
        return [s] if s < g.terminals else derive(g.left[s - g.terminals]) + derive(g.right[s - g.terminals])

    assert [w for s in g.sym for w in derive(s)] == x.tolist() and len(g.left) > 5
    pairs = Counter((a, b) for a, b, s, t in zip(g.sym, g.sym[1:], g.text, g.text[1:]) if s == t and a != b)
    assert not pairs or max(pairs.values()) == 1  # nothing left to replace


def test_runs_query_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_WORDS", 3000)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in L.op13_periodic_runs(spark, SF).collect()}
    assert got.keys() == texts.keys() and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in texts)
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        if len(w) > 1500:
            continue  # brute force would take too long
        runs = plain_runs(w)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        kept = [x for j, x in enumerate(w) if not any(s + p <= j < s + n for s, n, p in runs)]
        want = (i, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        assert tuple(got[i]) == want


def test_runs_of_hard_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, "x" * 9), (None, "a " * 9), (5, "Ñ b\xa0c " * 6), (5, "Ñ b\xa0c " * 6), (6, "a b")]
    got = bag(P.periodic_runs(docs_frame(spark, rows)))
    run = lambda n, p: [(0, n, p)]
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 1, [], "x" * 9), (None, 9, run(9, 1), "a"), (6, 2, [], "a b")] + [(5, 12, run(12, 2), "Ñ b\xa0c")] * 2
    assert sorted(((a, b, [tuple(r) for r in c], d) for a, b, c, d in got), key=repr) == sorted(want, key=repr)
    assert bag(P.periodic_runs(spark.createDataFrame([], DOCS))) == []
