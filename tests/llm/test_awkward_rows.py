"""Every operator and pipeline stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import langid, licenses, mixing, pieces, sharding, simhash, substring, tiff, topk, urlfilter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRAS = ["gone", "of", "found", "doc_id_", "__row", "__copy", "__gone", "weak", "node", "lam", "range", "fp", "spans", "size", "copies", "slot", "shard", "key", "rep", "component", "__x", "words", "rank", "anchors", "owner", "first", "ids"]
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))


def rows():
    same = "the same words again and again in this text of ten"
    return [
        (1, same, "en", "a", 5), (1, same, "en", "a", 5), (2, same, None, "b", 5), (3, None, "en", None, None), (4, "", "fr", "a", 0),
        (5, " \t\n ", "fr", "b", 4), (6, LONG, "en", None, len(LONG)), (7, LONG + " end", "de", "c", 1), (None, same, "en", "a", 1),
        (None, None, None, None, None), (8, "123 456 !!! 789", "es", "c", 1), (9, "Ünïcödé ▁ text  with\u00a0blanks ", "de", "c", 1), (10, "x", "es", "c", 1),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in EXTRAS})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "substring": lambda d: substring.removals(d),
    "mixing": mixing.mix,
    "simhash": simhash.near_duplicates,
    "tiff": tiff.round_trip,
    "sharding": sharding.place,
    "licenses": licenses.licenses,
    "pieces": pieces.round_trip,
    "langid": langid.identify,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, docs, empty):
    got = OPERATORS[name](docs).select("doc_id").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((r[0] is not None, r[0] or 0) for r in rows())
    assert OPERATORS[name](empty).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(name, stage, spark, docs, empty):
    out = stage(spark, docs, "")
    if name != "sentencepiece":
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    assert out.count() > 0
    assert stage(spark, empty, "").count() == 0


def test_substring_rules(docs):
    got = {(r.doc_id, r.n_words): r for r in substring.removals(docs, texts=True).collect()}
    long = got[7, 30001]
    assert long.n_removed == 30000 and bytes(long.kept) == b"end"
    assert got[6, 30000].n_removed == 0 and got[3, 0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[1, 11].n_removed == 0


def test_simhash_rules(docs):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    zero = bytes(8)
    assert [bytes(got[i].fp) for i in (3, 4, 5)] == [zero] * 3 and got[5].component_id == 3
    assert got[2].component_id == 1 and got[1].component_id == 1


def test_mixing_rules(docs):
    got = mixing.mix(docs).collect()
    assert all(0 <= r.copies <= 2 and r.taken == r.size * r.copies for r in got)
    assert Counter(map(tuple, mixing.mix(docs.repartition(7)).collect())) == Counter(map(tuple, got))


def test_mixed_rows_keep_odd_names(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "x", 1), (2, "d e", None, None, 2)], SCHEMA).withColumns({"a`b": F.lit(1), "c.d": F.lit(2)})
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}


def test_tiff_rules(docs):
    for r in tiff.round_trip(docs).collect():
        assert r.payload_bytes % 64 == 0 and r.payload_bytes >= max(64, r.n_bytes)
    null = [r for r in tiff.round_trip(docs).collect() if r.doc_id == 3][0]
    assert (null.n_bytes, null.payload_bytes, null.payload_sha256, null.tail_crc32) == (0, 64, hashlib.sha256(bytes(64)).hexdigest(), zlib.crc32(bytes(64)))


def test_language_rules(docs):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert [got[i].lang_pred for i in (3, 4, 5, 8)] == ["und"] * 4 and all(0 <= r.score <= 1 for r in got.values())
    assert got[1].held_out == (zlib.crc32(b"1") % 4 == 2)
    assert langid.predict(docs, {}).filter("lang_pred <> 'und'").count() == 0


def test_pieces_rules(docs):
    got = {r.doc_id: r for r in pieces.round_trip(docs).collect()}
    assert got[3].same is None and got[3].n_tokens == 0 and got[4].same and got[6].same and not got[9].same
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()}
    assert back[3] is None and back[4] == "" and back[6] == LONG and back[5] == " \t\n "


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [9.0, 9.0]), (100, [0.0005, -0.0005]), (7, [1.0]), (8, []), (200, []), (300, [3e38, 1.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in EXTRAS})
    got = [tuple(r) for r in topk.search(df, df.filter("vec_id % 100 = 0"), 3).orderBy("query_id", "rank").collect()]
    top = 1024 * 1024 + 2048 * 2048
    assert [g for g in got if g[0] == 0] == [(0, 1, 300, 2**63 - 1), (0, 2, 1, top), (0, 3, 2, top)]
    assert [g for g in got if g[0] == 100] == [(100, 1, 300, -1024), (100, 2, 0, -2048), (100, 3, 0, -2048)]
    assert [g for g in got if g[0] == 200] == [(200, 1, 8, 0)]
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://net", "http://net/", "http://xnet/", "x://example.net?en/", "ftp://org/fr/", "a://b://net/", "http://example.net/en/1", "http://..net/", "http://example.net/en/1",
            "http://net,example/en/a", "http://org,x/fr/1", "http://net,foo/", "http://com,example/de/", "http://a,b.example.net/en/", "http://\u0130.ORG/fr/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({c: F.lit(1) for c in EXTRAS})
    got = {r.page_id: tuple(r)[1:] for r in urlfilter.judge_urls(pages, urlfilter.rule_table(spark)).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
        fits = [(len(h + p), h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (host, path, *(max(fits)[1:] if fits else (None, "allow"))), u
    assert all(got[urls.index(u)][2:] == (None, "allow") for u in urls if u and "," in u and "example.net/en" not in u)
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert urlfilter.judge_urls(pages, none).filter("verdict = 'allow'").count() == len(urls)
    assert urlfilter.judge_urls(pages.limit(0), urlfilter.rule_table(spark)).count() == 0
