"""The ten operators against brute force, the library or SQL, and on hard rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import decontaminate as D, imatch, language, packing, queries as L, repeats as R, simhash as S
from cartwise.llm import token_counts as C, token_store as T, url_filter as U, warc as W
from cartwise.llm.common import ship_package
from cartwise.llm.tokens import PrefixCounts, WordIds

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, word string"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.fixture(scope="module")
def rows():
    """Nulls, empties, ties, repeated rows, copies, near copies, a long text, extra columns."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "Ñandú", "delta,", "x1", "rho.", "日本", "kappa"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(60)
    texts = [None, "", "   ", "a", "12 34", base, base, base + " extra", text(4000), "\n" + base, f"zzz {PASSAGE.upper()} yyy", PASSAGE, "x" * 120, "x" * 49]
    out = [(i, t, "en" if i % 2 else None, "s", None, "c", "w") for i, t in enumerate(texts)]
    return out + [out[5], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    ship_package(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    ship_package(spark)
    return spark.createDataFrame([], SCHEMA)


def test_language_id_learns_and_rejects(spark, docs, empty):
    train = spark.createDataFrame([(i, t, k, "s", None, "", "") for i, (t, k) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 40)], SCHEMA)
    model = language.train(train)
    assert model.predict("the dog") [0] == "en" and model.predict("die katze und der")[0] == "de"
    assert model.predict(None) == model.predict("12 !") == ("und", 0.0)
    got = docs.select("text", language.predictor(docs, model)(F.col("text")).alias("p")).collect()
    assert all((r.p.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.p.score <= 1 for r in got)
    nothing = language.train(empty)
    assert nothing.predict("the dog") == ("und", 0.0)


def test_language_id_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in L.op1_language_id(spark, sf).collect() if r.held_out and truth[r.doc_id]]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.95


def test_token_store_round_trip(spark, docs, empty, rows, tmp_path):
    tok = WordIds(L.WORD_TOKENIZER).tokenizer
    T.write_tokens(docs, str(tmp_path / "t"), L.WORD_TOKENIZER, 2)
    got = T.with_crc32(T.read_tokens(spark, str(tmp_path / "t"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted(zlib.crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for _, t, *_ in rows)
    assert sorted(r.ids_crc32 for r in got) == want
    assert [r.doc_id for r in T.read_documents(spark, str(tmp_path / "t"), [8]).collect()] == [8]
    T.write_tokens(empty, str(tmp_path / "e"), L.WORD_TOKENIZER, 2)
    assert T.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_prefix_counts_are_the_librarys():
    rng = random.Random(1)
    p = PrefixCounts(L.BYTE_TOKENIZER, 50)
    bits = ["a", "ing", " ", "  ", "\n", " \n", "'re", "'ll", "1", ".", "!!", "ñ", "日本", "́", "<|endoftext|>", "<|end", "\xa0", "\x1c", "THE", "😀", "\r\n"]
    for _ in range(400):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        want = [len(p.tokenizer.encode(s[:i], add_special_tokens=False).ids) for i in range(len(s) + 1)]
        assert p.counts(s).tolist() == want, repr(s)


def test_word_ids_are_the_librarys():
    rng = random.Random(2)
    w = WordIds(L.WORD_TOKENIZER, 50)
    bits = ["a", "Cat", " ", "\n", "'re", "1", ".", ",", "é", "é", "İ", "ß", "Σ", "日本", "<|endoftext|>", "\xa0", "\x1c", "한", "😀"]
    for _ in range(600):
        s = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert w.encode(s) == np.array(w.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), repr(s)


def test_prefix_tables_answer_questions(docs):
    got = C.prefix_counts(docs, L.BYTE_TOKENIZER).select(
        "text", C.total(F.col("prefix_tokens")).alias("n"), C.count_at(F.col("prefix_tokens"), 1).alias("one"), C.longest_prefix(3)("prefix_tokens").alias("fit")).collect()
    tok = PrefixCounts(L.BYTE_TOKENIZER).tokenizer
    for r in got:
        text = r.text or ""
        count = lambda s: len(tok.encode(s, add_special_tokens=False).ids)
        assert r.n == count(text) and r.one == (count(text[:1]) if text else None)
        if len(text) < 500:
            assert r.fit == max(i for i in range(len(text) + 1) if count(text[:i]) <= 3)


def test_simhash_components_match_all_pairs(spark, docs, empty, rows):
    import xxhash

    def brute(text):
        w = (text or "").encode().lower().split()
        if not w:
            return 0
        sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
        hs = [xxhash.xxh64_intdigest(x, 42) for x in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    got = S.near_duplicates(docs).collect()
    assert sorted(r.fingerprint for r in got) == sorted(f"{brute(t):016x}" for _, t, *_ in rows)
    prints = sorted({int(r.fingerprint, 16) for r in got})
    root = {p: p for p in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    for r in got:
        ids = [x.doc_id for x in got if root[int(x.fingerprint, 16)] == root[int(r.fingerprint, 16)] and x.doc_id is not None]
        assert r.component_id == (min(ids) if ids else None)
    assert S.near_duplicates(empty).count() == 0
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.component_id for r in got if r.component_id is not None})


def test_linked_parts_of_large_postings_match_all_pairs():
    rng = np.random.default_rng(0)
    rest = np.unique(np.concatenate([rng.integers(0, 1 << 16, 150), 1 << np.arange(16)]))
    root = S._linked(rest)
    want = np.arange(len(rest))
    near = np.bitwise_count(rest[:, None] ^ rest[None, :]) <= 2
    for _ in rest:
        want = np.array([want[n].min() for n in near])
    assert (root == want).all()


def test_decontamination_matches_sql_on_hard_rows(spark, docs, empty):
    bench = spark.createDataFrame([(1, PASSAGE), (2, "alpha beta"), (3, None), (4, "..."), (5, PASSAGE), (11, "x1")], "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").where("doc_id IS NOT NULL").dropDuplicates().toPandas())
    con.register("benchmark", bench.toPandas())
    want = con.sql(L.ORACLE_SQL["op5_decontaminate"]).fetchall()
    got = D.decontaminate(docs.where("doc_id IS NOT NULL").select("doc_id", "text").dropDuplicates(), bench).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert D.decontaminate(empty, bench).count() == 0 and D.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    clean = D.without_contaminated(docs, bench)
    assert clean.columns == docs.columns and {8, 10, 11}.isdisjoint(r.doc_id for r in clean.collect())


def test_warc_revisits(spark, tmp_path):
    ship_package(spark)
    html = "<p>\r\n\r\nWARC/1.1\r\n</p>"
    pages = spark.createDataFrame([(3, "http://a/\nb", html), (1, None, html), (2, "http://c", None), (5, "u", ""), (1, None, html), (None, "n", html), (9, "ü", "é")], "page_id long, url string, html string")
    W.write_archives(pages, str(tmp_path / "w"))
    got = sorted(map(tuple, W.read_archives(spark, str(tmp_path / "w")).collect()), key=repr)
    n, dig = len(html), W.base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    none = "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    e = W.base64.b32encode(hashlib.sha1("é".encode()).digest()).decode()
    want = [(1, n, dig, "response", None)] * 2 + [(3, n, dig, "revisit", 1), (None, n, dig, "revisit", 1), (2, 0, none, "response", None), (5, 0, none, "revisit", 2), (9, 2, e, "response", None)]
    assert got == sorted(want, key=repr)
    W.write_archives(pages.limit(0), str(tmp_path / "e"))
    assert W.read_archives(spark, str(tmp_path / "e")).count() == 0


def test_imatch_edits_and_likeness(docs, empty, rows):
    got = imatch.fingerprints(docs).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1] or ""))
    want = []
    for r, after in zip(order, order[1:] + order[:1], strict=True):
        want.append((r[0], len(r[1] or ""), hashlib.sha256(imatch.edit(r[1] or "", after[1] or "").encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    prints = {}
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert imatch.fingerprints(empty).count() == 0


def test_url_rules_nest(spark):
    ship_package(spark)
    urls = [None, "", "no scheme", "http://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://www.example.com/EN/", "http://x.net/es/?q", "https://net/fr/a#b", "http://com", "http://com/", "http://notcom/", "http://a.b.www.example.com/en/x", "ftp://net.evil.org/es/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3])], "page_id long, url string")
    con = duckdb.connect()
    con.register("pages", spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").toPandas())
    want = con.sql(L.ORACLE_SQL["op8_url_filter"]).fetchall()
    got = list(map(tuple, U.filter_urls(pages, U.rule_table(spark, L.RULES)).collect()))
    assert sorted(set(got), key=repr) == sorted(want, key=repr) and len(got) == len(urls) + 1
    assert {r.verdict for r in U.filter_urls(pages, U.rule_table(spark, L.RULES).limit(0)).collect()} == {"allow"}


def test_packing_places_every_token_once(docs, empty, rows):
    got = packing.pack_documents(docs, L.WORD_TOKENIZER, 1, segments=3).collect()
    total = sum({(r.doc_id, r.doc_tokens): r.doc_tokens for r in got}.values())
    assert total and sum(r.length for r in got) == sum(len(WordIds(L.WORD_TOKENIZER).encode(t)) // 4 + 1 for _, t, *_ in rows)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for pieces in by.values():
        pieces.sort(key=lambda r: r.offset)
        size = sum(r.length for r in pieces)
        assert len(pieces) <= 3 and size <= 2048 and size & (size - 1) == 0
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
    assert packing.pack_documents(empty, L.WORD_TOKENIZER, 1).count() == 0


def test_packing_keeps_the_limit_on_loss():
    sizes, loss = np.array([1500, 900, 40, 3000]), np.array([0.5, 1.0, 0.0, 0.25])
    for sequence in packing.pack_block(sizes, loss, 2048, 4, 700):
        assert sum(n for *_, n in sequence) <= 2048 and sum(n * loss[r] for r, _, n in sequence) <= 700 + 1e-6


def test_repeats_match_brute_force(docs, empty, rows):
    owner = {}
    for i, t, *_ in rows:
        if i is not None:
            b = (t or "").encode()
            for k in range(len(b) - 49):
                owner[b[k:k + 50]] = min(owner.get(b[k:k + 50], i), i)
    want = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if i is not None and owner[b[k:k + 50]] < i:
                gone[k:k + 50] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        want.append((i, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    got = R.repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert R.repeats(empty).count() == 0


def test_suffix_passes_keep_equal_beginnings_together(monkeypatch):
    monkeypatch.setattr(R, "PASS", 100)
    text = np.frombuffer(np.random.default_rng(1).integers(97, 99, 3000, np.uint8).tobytes() * 2, np.uint8)
    at = np.arange(len(text) - R.LENGTH + 1)
    groups = list(R._passes(text, at))
    assert len(groups) == -(-len(at) // 100) and sorted(np.concatenate(groups)) == list(at)
    of = {int(i): g for g, mine in enumerate(groups) for i in mine}
    assert all((np.diff(mine) > 0).all() for mine in groups)
    assert all(of[i] == of[i + 3000] for i in range(3000 - R.LENGTH))
    assert list(R._passes(text, at[:0])) == []
