import random

import numpy as np
import pytest

import corpus_pipeline
from folioforge.llm import common, graph, simhash


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def least_of_component(texts, least=0.8):
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if root[a] != root[b] and jaccard(texts[a], texts[b]) >= least:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang", "'s' source", "length(text) n_chars")


def variants(rng, n, changes):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    out = []
    for _ in range(n):
        base = [word() for _ in range(404)]
        out.append(" ".join(base))
        for c in changes:  # c words changed far apart: similarity (400 - 5 c) / (400 + 5 c)
            w = list(base)
            for p in range(c):
                w[4 + p * (400 // c)] = word()
            out.append(" ".join(w))
    return out


def test_only_pairs_of_the_similarity_are_joined(spark):
    rng = random.Random(8)
    low = variants(rng, 30, [12])  # 0.74
    high = variants(rng, 30, [4])  # 0.90
    texts = low + high
    left = {r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, table(spark, list(enumerate(texts))), "").select("doc_id").collect()}
    assert set(range(len(low))) <= left
    assert {len(low) + i for i in range(0, 60, 2)} <= left
    assert len(left & {len(low) + i for i in range(1, 60, 2)}) <= 1


def test_equal_fingerprints_are_compared_too(spark):
    line = "one two three four five "  # its shingles outnumber all others, so they alone decide the fingerprint
    texts = [line * 200 + " ".join(f"{c}{i}" for i in range(60)) for c in "abc"] + ["", None, line]
    df = table(spark, list(enumerate(texts)))
    got = {r.doc_id: (bytes(r.fp), r.component_id) for r in simhash.similar_documents(df).collect()}
    assert {i: c for i, (_, c) in got.items()} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 5}


def test_rows_without_id_and_repeated_ids(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    df = table(spark, [(5, a), (5, b), (7, a), (None, a), (None, "other"), (3, b)])
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.similar_documents(df).collect() if r.doc_id is not None)
    assert got == [(3, 3), (5, 3), (5, 5), (7, 5)]


@pytest.mark.parametrize("n", [40, 200])  # one group, and dealt out in blocks
def test_components_are_exact_in_a_large_group(spark, n):
    rng = random.Random(n)
    base, texts = [f"w{i}" for i in range(150)], []
    for _ in range(n):
        w = list(base)
        for p in rng.sample(range(150), rng.randint(1, 12)):
            w[p] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    nodes = list(map(simhash.ShingleSets(5).of, texts))
    ids = [simhash.set_id(h) for h in nodes]
    own = spark.createDataFrame(list(zip(ids, range(n))), "node long, rep long")
    loose = spark.createDataFrame([(i, min(ids)) for i in ids], "node long, component long")
    scratch = common.Scratch(spark, "t")
    labels = {r.node: r.component for r in graph.connected_components(simhash.similar(table(spark, list(enumerate(texts))), own, loose, scratch, 5, 0.8), scratch).collect()}
    want = least_of_component(texts)
    assert 1 < len(set(want)) < n
    got = [labels.get(i, i) for i in ids]
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in range(n) for b in range(a))


def test_pairs_of_the_similarity_are_found(spark):
    """Recall on pairs of 0.8 to 0.82, the hardest that count: 0.97 are compared on average, so 0.9 of 300 is a wide margin."""
    rng = random.Random(31)
    texts, pairs = [], 0
    for a, b in zip(*[iter(variants(rng, 300, [8]))] * 2):  # 8 words in 404: 0.81
        assert 0.8 <= jaccard(a, b) < 0.85
        texts += [a, b]
        pairs += 1
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(table(spark, list(enumerate(texts)))).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(pairs)) >= 0.9 * pairs
    assert all(got[2 * i] == 2 * i for i in range(pairs))
