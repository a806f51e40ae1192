import random

from folioforge.operators import evaluate
from folioforge.plans import catalogue


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_edit_distance_equals_the_table():
    rng = random.Random(1)
    word = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    for _ in range(400):
        a, b = word(rng.randint(0, 90), "abé😀"), word(rng.randint(0, 90), "abé😀")
        assert evaluate.edit_distance(a, b) == brute_distance(a, b)
        c = a[:20] + b[:3] + a[22:]
        assert evaluate.edit_distance(a, c) == brute_distance(a, c)


def test_cer_of_whole_texts(spark, tmp_path):
    head = "same beginning " * 20  # 300 characters
    texts = [head + "tail one", head + "another end", "été à Noël", "ete a Noel", "", "x", None, "y"]
    rows = [(i, t, "fr" if i % 2 else "en") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.cer for r in catalogue.QUERIES["cer_pairs"](spark, str(tmp_path)).collect()}
    want = {}
    for i, (a, b) in enumerate(zip(texts, texts[1:])):
        want[i] = None if a is None else round(brute_distance(a, b) / len(b), 6) if b else float(a != "")  # no label counts as an empty one
    assert got == want and got[0] > 0 and got[2] == 0.4
    summary = {r.lang: r for r in catalogue.QUERIES["cer_summary"](spark, str(tmp_path)).collect()}
    assert summary["en"].pairs == 4 and summary["en"].max_cer == max(v for i, v in want.items() if i % 2 == 0 and v is not None)


def test_distances_abreast_equal_those_of_single_pairs(monkeypatch):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdé😀 ") for _ in range(n))
    pairs = [(word(rng.randint(0, 700)), word(rng.randint(0, 700))) for _ in range(900)]
    pairs += [(a, a[:100] + b[:3] + a[105:]) for a, b in pairs[:20]] + [("", ""), ("a", ""), ("", "bc"), ("\ud800x", "x"), ("x" * 64, "y" * 64), ("x" * 65, "x"), ("ab" * 4000, "ba" * 3000)]
    want = [evaluate.edit_distance(a, b) for a, b in pairs]
    single, alone = [], evaluate.edit_distance
    monkeypatch.setattr(evaluate, "edit_distance", lambda a, b: single.append(a) or alone(a, b))
    assert evaluate.edit_distances(pairs) == want and len(single) < len(pairs) / 2
    assert evaluate.edit_distances(pairs, words=300) == want and evaluate.edit_distances(pairs, room=1) == want and evaluate.edit_distances([]) == []
