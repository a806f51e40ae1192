import functools
import hashlib
import itertools
import math
import random
import struct
import time
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
from oracle import same
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import common, graph, langid, licenses, mixing, pieces, queries, sharding, simhash, substring, tiff, topk

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    assert same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], SF) > 0


@pytest.mark.parametrize("size,seed", [(4, 1), (7, 2), (50, 3)])
def test_substring(spark, size, seed):
    rng = random.Random(seed)
    parts = [[rng.choice("abcdef") for _ in range(rng.randint(size, 3 * size))] for _ in range(6)]
    texts = [" ".join(sum((rng.choice(parts)[rng.randint(0, 3) :] for _ in range(rng.randint(0, 4))), [])) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in substring.removals(df, size, texts=True).collect()}
    seen = {}
    for i, t in enumerate(texts):
        w = t.split()
        gone = set()
        for p in range(len(w) - size + 1):
            if seen.setdefault(tuple(w[p : p + size]), i) < i:
                gone |= set(range(p, p + size))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        assert (got[i].n_words, got[i].n_removed) == (len(w), len(gone))
        assert bytes(got[i].kept).decode() == (kept if gone else t)


def brute_removals(texts, size):
    """[(words, removed, kept)] by comparing windows word for word."""
    seen, out = {}, []
    for i, t in enumerate(texts):
        w, gone = (t or "").split(), set()
        for p in range(len(w) - size + 1):
            if seen.setdefault(tuple(w[p : p + size]), i) < i:
                gone |= set(range(p, p + size))
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def test_index_outlives_the_session(spark, tmp_path):
    """Batches added one by one, each by an index opened anew in another session, give what one pass over all gives."""
    rng = random.Random(12)
    parts = [[rng.choice("abcdef") for _ in range(rng.randint(8, 24))] for _ in range(8)]
    texts = [" ".join(sum((rng.choice(parts)[rng.randint(0, 3) :] for _ in range(rng.randint(0, 4))), [])) for _ in range(60)]
    want, folder, got = brute_removals(texts, 8), str(tmp_path / "index"), {}
    table = lambda session, a, z: session.createDataFrame(list(enumerate(texts))[a:z], "doc_id long, text string")
    cuts = [0, 20, 27, 27, 45, 60]
    for n, (a, z) in enumerate(zip(cuts, cuts[1:])):
        session = spark.newSession()
        index = substring.FingerprintIndex(session, folder, max_runs=2)
        assert len(index.batches) == n and len(index.runs) <= 2
        earlier = table(session, 0, a) if n else None
        got |= {r.doc_id: r for r in substring.add_batch(index, f"b{n}", table(session, a, z), earlier, 8).collect()}
    assert [(got[i].n_words, got[i].n_removed) for i in range(60)] == [x[:2] for x in want]
    assert all(bytes(got[i].kept).decode() == (want[i][2] if want[i][1] else texts[i]) for i in range(60))
    index = substring.FingerprintIndex(spark, folder)
    run = index.run(index.runs[0])
    assert [r.fingerprint for r in run.sort("fingerprint").collect()] == sorted({r.fingerprint for r in run.collect()})
    with pytest.raises(ValueError):
        index.add("b0", index.documents(), common.Scratch(spark, "t"))


def test_a_batch_that_fails_leaves_the_index(spark, tmp_path):
    folder = str(tmp_path / "index")
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    substring.add_batch(substring.FingerprintIndex(spark, folder), "one", docs, size=3).collect()
    index = substring.FingerprintIndex(spark, folder)
    index.add("two", index.documents(), common.Scratch(spark, "t"))  # and no commit
    again = substring.FingerprintIndex(spark, folder)
    assert list(again.batches) == ["one"] and len(again.runs) == 1
    with pytest.raises(ValueError):
        substring.add_batch(again, "two", docs, size=3)  # the texts of batch one are missing


def reference_fingerprint(text, k=3):
    w = text.encode().lower().split()
    sh = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(n, linked):
    root = list(range(n))
    for a, b in itertools.combinations(range(n), 2):
        if linked(a, b):
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_simhash(spark, docs):
    got = {r.doc_id: r for r in queries.op4_simhash(spark, SF).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    fps = [reference_fingerprint(t) for _, t in rows]
    comp = components(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    for i, (d, _) in enumerate(rows):
        assert got[d].fingerprint == f"{fps[i]:016x}" and got[d].component_id == rows[comp[i]][0]


@pytest.mark.parametrize("bits,t,parts", [(64, 2, None), (64, 5, None), (64, 8, 4), (128, 6, 3)])
@pytest.mark.parametrize("hot", [6, 20, 20_000])  # dealt out anew, in blocks too, and not at all
def test_links_lose_none(spark, bits, t, parts, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = np.random.default_rng(bits + t)
    base = rng.integers(0, 256, (12, bits // 8), np.uint8)
    rows = [base[0]]
    for _ in range(150):
        x = np.unpackbits(base[rng.integers(0, 3 if rng.random() < 0.7 else 12)])
        x[rng.choice(bits, rng.integers(0, t + 1), replace=False)] ^= 1
        rows.append(np.packbits(x))
    fps = np.unique(np.array(rows), axis=0)
    df = spark.createDataFrame([(bytearray(f.tobytes()), i) for i, f in enumerate(fps)], "fp binary, rep long")
    scratch = common.Scratch(spark, "t")
    edges = simhash.link_fingerprints(df, scratch, t, parts=parts)
    labels = {r.node: r.component for r in graph.connected_components(edges, scratch).collect()}
    want = components(len(fps), lambda a, b: np.unpackbits(fps[a] ^ fps[b]).sum() <= t)
    assert [labels.get(i, i) for i in range(len(fps))] == want


def test_thresholds_add_up():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 2, (200, 64), np.uint8)
    for t in (2, 5, 9):
        scheme = simhash.plan(sample, 10**6, t)
        assert sum(e + 1 for _, e in scheme) == t + 1
        assert len({b for g, _ in scheme for b in g}) == sum(len(g) for g, _ in scheme)


def test_likely_thresholds():
    """They give the recall asked for, spend more where it is cheaper, and partitions grow with the table."""
    rng = np.random.default_rng(3)
    sample = rng.integers(0, 2, (400, 256), np.uint8)
    sizes = []
    for n in (10**4, 10**6, 10**8):
        scheme = simhash.likely_plan(sample, n, 0.8, 0.97)
        missed = np.prod([1 - simhash.meeting(len(g), f, 0.8) for g, f in scheme])
        assert missed <= 0.03
        sizes.append(min(len(g) for g, _ in scheme))
    assert sizes == sorted(sizes) and sizes[0] < sizes[-1]
    skewed = sample.copy()
    skewed[:, 64:] &= skewed[:, :1]  # three quarters of the bits are mostly clear, and so tell little apart
    scheme = simhash.likely_plan(skewed, 10**7, 0.8, 0.9)
    assert len({f for _, f in scheme}) > 1
    with pytest.raises(ValueError):
        simhash.likely_plan(sample[:, :64], 10**6, 0.8, 1 - 1e-12)


def test_meeting_equals_a_simulation_by_definition():
    rng, rho, n = np.random.default_rng(5), 2 * 0.8 / 1.8, 3000
    for bits, flips in ((12, 2), (20, 4)):
        a = rng.normal(size=(n, bits))
        b = rho * a + np.sqrt(1 - rho * rho) * rng.normal(size=(n, bits))
        met = 0
        for x, y in zip(a, b):
            values = []
            for m in (x, y):
                v = sum(1 << i for i in range(bits) if m[i] > 0)
                values.append({v} | {v ^ (1 << int(i)) for i in np.argsort(abs(m))[:flips]})
            met += bool(values[0] & values[1])
        assert met / n == pytest.approx(simhash.meeting(bits, flips, 0.8), abs=0.04)


@pytest.mark.parametrize("bits", [64, 256])
def test_margins(bits):
    rng = np.random.default_rng(bits)
    sizes = np.array([0, 1, 255, 256, 3, 0, 70_000, 511])
    h = rng.integers(0, 1 << 63, sizes.sum(), np.uint64) * np.uint64(2)
    got, at = simhash.margins(h, sizes, bits), 0
    for row, n in zip(got, sizes):
        part, at = h[at : at + n], at + n
        want = [2 * int((part >> np.uint64(63 - i) & np.uint64(1)).sum()) - n for i in range(64)]
        assert row[:64].tolist() == want


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (500, 8), np.uint8)
    sample = np.concatenate([x, x], axis=1)  # bit i + 8 repeats bit i
    groups = simhash.bit_groups(sample, 4)
    assert all({(b + 8) % 16 for b in g} == set(g) for g in groups)


def test_near_copies_in_the_pipeline_stage(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    rows, near = [], []
    for i in range(60):
        w = [word() for _ in range(300)]
        rows.append((10 * i, " ".join(w)))
        for _ in range(rng.choice((0, 0, 3))):  # one word in 150 changed: similarity of about 0.93
            c = list(w)
            for p in rng.sample(range(300), 2):
                c[p] = word()
            near.append(10 * i + len(near) % 9 + 1)
            rows.append((near[-1], " ".join(c)))
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in dict(rows).items()], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, df, "").select("doc_id").collect()}
    assert {10 * i for i in range(60)} <= left
    assert len(left & set(near)) <= 0.05 * len(set(near))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 102)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(chain, "u long, v long"), common.Scratch(spark, "t")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def brute_copies(rows, cap=2.0):
    """(doc_id, size, source) -> copies of each row: multipliers by bisection, then the last copies one document after the other."""
    sums, out = {}, {}
    for _, size, source in rows:
        sums[source] = sums.get(source, 0) + size
    for source, target in mixing.targets(sums).items():
        own = [(d, n) for d, n, s in rows if s == source]
        longest = max([n for _, n in own] + [1])

        def rates(lam):
            return [1.0 if not n else min(cap, math.exp(min(50.0, lam * n / longest))) for _, n in own]

        if not sums[source] or target >= cap * sums[source] * (1 - 1e-12):
            rate = [1.0 if not n else cap for _, n in own] if sums[source] else [1.0] * len(own)
        else:
            low, high = -1e6, 1e6
            for _ in range(200):
                mid = (low + high) / 2
                low, high = (mid, high) if sum(r * n for r, (_, n) in zip(rates(mid), own)) < target else (low, mid)
            rate = rates(low)
        need, spots = target - sum(math.floor(r) * n for r, (_, n) in zip(rate, own)), []
        for i, (r, (d, n)) in enumerate(zip(rate, own)):
            out.setdefault((d, n, source), math.floor(r))
            if n and r > math.floor(r):
                chain = 42 if d is None else xxhash.xxh64_intdigest(struct.pack("<q", d), 42)
                draw = xxhash.xxh64_intdigest(struct.pack("<q", n), chain) % (1 << 40) / (1 << 40)
                spots.append((draw - (r - math.floor(r)), n, i))
        for _, n, i in sorted(spots):
            if need < n / 2:
                break
            need -= n
            d, n, _ = (*own[i], source)
            out[d, n, source] += 1
    return out


def test_mixing_equals_a_plain_fit(spark, docs):
    nulls = spark.createDataFrame([(10_001, "one two three", None), (10_002, "four five " * 30, None), (10_003, None, None), (10_004, "x " * 9, "")], "doc_id long, text string, source string")
    all_docs = docs.select("doc_id", "text", "source").unionByName(nulls)
    rows = [(r.doc_id, len((r.text or "").split()), r.source) for r in all_docs.collect()]
    want = brute_copies(rows)
    source = {d: s for d, _, s in rows}
    got = {(r.doc_id, r["size"], source[r.doc_id]): r.copies for r in mixing.mix(all_docs).collect()}
    assert got.keys() == want.keys() and sum(got[k] != want[k] for k in want) == 0


def test_target_table_equals_targets(spark):
    rng = random.Random(2)
    sizes = {f"s{i}": rng.choice((0, 1, 5, 100, 10_000)) for i in range(40)} | {None: 77, "": 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.target_table(df, common.Scratch(spark, "t")).collect()}
    want = mixing.targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)
    assert mixing.target_table(df.limit(0), common.Scratch(spark, "t")).count() == 0


def test_mixing(spark, docs):
    got = mixing.mix(docs).toPandas().merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    want = mixing.targets({s: int(n) for s, n in got.groupby("source")["size"].sum().items()})
    for s, g in got.groupby("source"):
        assert abs(g.target.iloc[0] - want[s]) < 1e-6 * want[s]
        assert abs(g.taken.sum() - want[s]) <= g["size"].max()
        assert abs((g.rate * g["size"]).sum() - want[s]) < 1e-4 * want[s]
    assert (got.taken <= 2 * got["size"]).all()


def test_salted_join_equals_broadcast(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(50)], "i int, k string")
    small = spark.createDataFrame([("hot", 1), (None, 2)], "k string, v int")
    a = sorted(map(tuple, common.join_bounded(df, small, "k").collect()))
    assert a == sorted(map(tuple, common.join_bounded(df, small, "k", max_rows=1).collect())) and len(a) == 50
    odd = df.withColumns({"m": F.struct(F.create_map(F.lit("a"), F.col("i"))), "a`b.c": F.array(F.create_map(F.lit(1), F.col("k")))})
    assert sorted(r.v for r in common.join_bounded(odd, small, "k", max_rows=1).collect()) == sorted(r[2] for r in a)


def test_targets():
    assert mixing.targets({"b": 100, "a": 100, None: 100}) == {"a": 200, "b": pytest.approx(250 / 3), None: pytest.approx(500 / 3)}


@pytest.mark.parametrize("kind", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
def test_tiff_round_trip(kind):
    rng = np.random.default_rng(kind)
    smooth = np.add.outer(np.arange(70), np.arange(53)).astype(np.uint8)
    pages = [smooth, rng.integers(0, 256, (40, 31, 3), np.uint8), np.zeros((300, 200), np.uint8), rng.integers(0, 65536, (20, 17), np.uint16)]
    for order, predictor, tile in itertools.product("<>", (1, 2), (None, (16, 32))):
        back = list(tiff.read_pages(tiff.write(pages, kind, predictor, order, 16, tile)))
        assert len(back) == 4
        for p, q in zip(pages, back, strict=True):
            assert (q.reshape(p.shape) == p).all()


def test_lzw_of_much_data():
    rng = random.Random(1)
    for data in (b"", b"a", bytes(rng.randrange(256) for _ in range(40_000)), b"abcab" * 9000, bytes(70_000)):
        assert tiff.unlzw(tiff.lzw(data)) == data and tiff.unpack_bits(tiff.pack_bits(data)) == data


def plain_lzw(data):
    """Another decoder: all codes' bits as one string, widths by counting codes."""
    bits, out, at = "".join(f"{b:08b}" for b in data), [], 0
    strings, width, last = {i: [i] for i in range(256)}, 9, None
    while True:
        code = int(bits[at : at + width], 2)
        at += width
        if code == 257:
            return bytes(out)
        if code == 256:
            strings, width, last = {i: [i] for i in range(256)}, 9, None
            continue
        now = strings[code] if code in strings else last + last[:1]
        if last is not None:
            strings[max(strings) + 1 if len(strings) > 256 else 258] = last + now[:1]
        out += now
        last = now
        n = 258 + len(strings) - 256
        width = next(w for w in (9, 10, 11, 12) if n < (1 << w) - 1 or w == 12)


def test_lzw_by_another_decoder():
    rng = random.Random(4)
    # the example of the format's specification: bytes 7 7 7 8 8 7 7 6 6
    codes = "".join(f"{c:09b}" for c in (256, 7, 258, 8, 8, 258, 6, 6, 257))
    packed = bytes(int(codes[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(codes), 8))
    assert tiff.unlzw(packed) == plain_lzw(packed) == bytes((7, 7, 7, 8, 8, 7, 7, 6, 6))
    for data in (bytes(rng.choice(b"abcd") for _ in range(30_000)), bytes(rng.randrange(256) for _ in range(9000)), bytes(5000)):
        assert plain_lzw(tiff.lzw(data)) == data


def plain_tiff(data):
    """Another reader, of 8-bit one-sample little-endian files: (form, samples end to end)."""
    number = lambda at, n: int.from_bytes(data[at : at + n], "little")
    at, out = number(4, 4), []
    while at:
        tags = {}
        for e in range(at + 2, at + 2 + 12 * number(at, 2), 12):
            size, n = {3: 2, 4: 4}[number(e + 2, 2)], number(e + 4, 4)
            place = e + 8 if size * n <= 4 else number(e + 8, 4)
            tags[number(e, 2)] = [number(place + size * i, size) for i in range(n)]
        w, h, kind = tags[256][0], tags[257][0], tags[259][0]
        tiled = 324 in tags
        bw, bh = (tags[322][0], tags[323][0]) if tiled else (w, tags[278][0])
        page = [[0] * w for _ in range(h)]
        for i, (o, c) in enumerate(zip(tags[324 if tiled else 273], tags[325 if tiled else 279])):
            raw = data[o : o + c]
            if kind == 8:
                raw = zlib.decompress(raw)
            elif kind == 5:
                raw = plain_lzw(raw)
            elif kind == 32773:
                rest, raw = raw, b""
                while rest:
                    n = rest[0]
                    part, rest = (rest[1 : n + 2], rest[n + 2 :]) if n < 128 else (rest[1:2] * (257 - n), rest[2:])
                    raw += part
            across = -(-w // bw)
            for r in range(len(raw) // bw):
                y, x0, total = i // across * bh + r, i % across * bw, 0
                for x in range(bw):
                    total = (total + raw[r * bw + x]) % 256 if tags[317][0] == 2 else raw[r * bw + x]
                    if y < h and x0 + x < w:
                        page[y][x0 + x] = total
        out.append(b"".join(map(bytes, page)))
        at = number(at + 2 + 12 * number(at, 2), 4)
    return b"".join(out)


def test_stored_texts_by_another_reader(spark):
    rng = random.Random(8)
    texts = [None, "", "a", "é" * 40] + ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(1, 400))) for _ in range(60)] + ["long " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    forms = set()
    for r in tiff.round_trip(df).collect():
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        form, media = tiff.store(payload)
        forms.add(form)
        assert plain_tiff(media) == payload
        want = (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == want
    assert forms == {f[0] for f in tiff.FORMS}


def test_long_payloads_run_over_pages():
    payload = bytes(range(256)) * 8192  # 2 MB
    assert len(list(tiff.read_pages(tiff.store(payload)[1]))) == 2
    assert b"".join(p.tobytes() for p in tiff.read_pages(tiff.store(payload)[1])) == payload


def test_bits_and_words():
    """Samples of 1, 4 and 32 bits, and planes apart, in files put together by hand."""
    def file(w, h, bits, raw, spp=1, planar=1, predictor=1):
        tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [bits] * spp), (259, 3, [1]), (277, 3, [spp]), (278, 4, [h]), (284, 3, [planar]), (317, 3, [predictor])]
        n, blocks = len(raw), spp if planar == 2 else 1
        tags += [(273, 4, [8 + n // blocks * i for i in range(blocks)]), (279, 4, [n // blocks] * blocks)]
        out, extra, fields = b"MM" + struct.pack(">HI", 42, 8 + n) + raw, b"", b""
        base = len(out) + 2 + 12 * len(tags) + 4
        for tag, t, v in sorted(tags):
            b = struct.pack(f">{len(v)}{'HI'[t - 3]}", *v)
            if len(b) > 4:
                b, extra = struct.pack(">I", base + len(extra)), extra + b
            fields += struct.pack(">HHI", tag, t, len(v)) + b.ljust(4, b"\0")
        return out + struct.pack(">H", len(tags)) + fields + bytes(4) + extra

    one = lambda f: next(tiff.read_pages(f))[:, :, 0].tolist()
    assert one(file(10, 2, 1, bytes((0b10101010, 0b11000000, 0b00000001, 0b01000000)))) == [[1, 0] * 4 + [1, 1], [0] * 7 + [1, 0, 1]]
    assert one(file(3, 1, 4, bytes((0x1F, 0x80)))) == [[1, 15, 8]]
    assert one(file(3, 1, 32, struct.pack(">3I", 1, 2, 2**32 - 1), predictor=2)) == [[1, 3, 2]]
    assert next(tiff.read_pages(file(2, 1, 8, b"abcd", spp=2, planar=2))).tolist() == [[[97, 99], [98, 100]]]


def test_tiff_table(spark):
    good = tiff.write([np.zeros((4, 4), np.uint8), np.ones((2, 3), np.uint8)])
    df = spark.createDataFrame([("a", bytearray(good)), ("b", bytearray(good[:60])), ("c", None), ("d", bytearray(b"nonsense")), ("e", bytearray())], "path string, content binary")
    got = tiff.pages(df).orderBy("path", "page").collect()
    assert [(r.path, r.page, r.width, r.error is None) for r in got if r.path == "a"] == [("a", 0, 4, True), ("a", 1, 3, True)]
    assert {r.path for r in got if r.error} == {"b", "d", "e"}


def test_damaged_files_give_error_rows(spark):
    """Bytes changed at random, and what has crashed readers before: tiles without size, empty tags, huge pages, a bad first LZW code."""
    rng = np.random.default_rng(6)
    img = rng.integers(0, 256, (40, 30), np.uint8)
    base = [tiff.write([img, img[:9]], kind, pred, order, 16, tile) for kind in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS) for pred in (1, 2) for order in "<>" for tile in (None, (16, 16))]
    files = []
    for i in range(1000):
        f = bytearray(base[i % len(base)])
        at = rng.integers(0, len(f), rng.integers(1, 6)) if i % 3 else len(f) - 1 - rng.integers(0, min(len(f), 330), rng.integers(1, 6))
        f[: 0] = b""
        for a in at:
            f[a] = rng.choice([0, 1, 255, rng.integers(0, 256)])
        files.append((f"r{i}", f if i % 10 else f[: rng.integers(0, len(f))]))

    def with_tag(f, tag, count=None, value=None):
        f = bytearray(f)
        (at,) = struct.unpack_from("<I", f, 4)
        for e in range(at + 2, at + 2 + 12 * struct.unpack_from("<H", f, at)[0], 12):
            if struct.unpack_from("<H", f, e)[0] == tag:
                if count is not None:
                    struct.pack_into("<I", f, e + 4, count)
                if value is not None:
                    struct.pack_into("<I", f, e + 8, value)
        return f

    tiled, strips = tiff.write([img], tiff.DEFLATE, tile=(16, 16)), tiff.write([img], tiff.LZW)
    bad = {"tile width 0": with_tag(tiled, 322, value=0), "no width": with_tag(strips, 256, count=0), "height 0": with_tag(strips, 257, value=0), "huge tile": with_tag(tiled, 322, value=400_000)}
    bad["huge"] = with_tag(with_tag(strips, 256, value=400_000), 257, value=400_000)
    lzw = bytearray(strips)
    lzw[8:11] = b"\xff\xff\xff"
    bad["first code"] = lzw
    df = spark.createDataFrame(files + list(bad.items()), "path string, content binary")
    got = tiff.pages(df.repartition(4)).select("path", "page", "error").collect()
    assert {r.path for r in got} == {p for p, _ in files} | set(bad)
    assert all(any(r.error for r in got if r.path == p) for p in bad)


def plain_table(shards, size):
    """Turn by turn: of all slots in the shard's order of preference, the first that nobody has."""
    order = {}
    for s in shards:
        d = hashlib.sha256(s.encode()).hexdigest()
        offset, skip = int(d[:16], 16) % size, int(d[16:32], 16) % (size - 1) + 1
        order[s] = iter([(offset + i * skip) % size for i in range(size)])
    owner = {}
    for s in itertools.cycle(shards):
        if len(owner) == size:
            return owner
        owner[next(x for x in order[s] if x not in owner)] = s


def test_lookup_table():
    shards = tuple(f"s{i}" for i in range(7))
    table = sharding.lookup_table(shards, 1009)
    want = plain_table(shards, 1009)
    assert [shards[i] for i in table] == [want[i] for i in range(1009)]
    count = [table.count(i) for i in range(7)]
    assert max(count) - min(count) <= 1
    fewer = sharding.lookup_table(shards[:-1], 1009)
    moved = sum(shards[a] != shards[b] for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 0.2 * 1009
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 1000)


def test_sharding_query(spark, docs):
    want = plain_table([f"shard-{i:03d}" for i in range(96)], 65537)
    got = queries.op7_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    for r in got:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % 65537
        assert (r.slot, r.shard) == (slot, want[slot])


def brute_licenses(text, templates=licenses.TEMPLATES):
    """Every window of every template's class, by sets of tuples of words."""
    words = lambda t: [w for w in (x.strip(licenses.EDGE.decode()) for x in t.lower().split()) if w]
    sh = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    found, w = {}, words(text)
    for name, t in templates.items():
        want, size = sh(words(t)), licenses.size_class(len(words(t)) - 4)
        stride = max(1, size // 4)
        got = max((len(want & sh(w[i : i + size + stride + 3])) / len(want) for i in range(0, max(1, len(w)), stride)), default=0)
        if got >= 0.8:
            found[name] = got
    return found


def test_licenses(spark):
    rng = random.Random(6)
    names, texts = sorted(licenses.TEMPLATES), []
    for i in range(60):
        w = [rng.choice("lorem ipsum dolor sit amet license the of".split()) for _ in range(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 3)):
            t = licenses.TEMPLATES[rng.choice(names)].split()
            if rng.random() < 0.4 and len(t) > 40:
                t[rng.randrange(len(t))] = "changed"
            p = rng.randint(0, len(w))
            w[p:p] = t if rng.random() < 0.8 else [x.upper() for x in t]
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.licenses(df).collect():
        want = brute_licenses(texts[r.doc_id])
        assert set(filter(None, r.licenses.split(","))) == set(want)
        assert r.best_containment == pytest.approx(max(want.values(), default=0), abs=1e-9)


def test_many_templates_cost_as_few():
    """500 templates of all sizes: what is found is what brute force finds, and other texts take about as long as with nineteen."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    templates = {f"t{i}": " ".join(word() for _ in range(rng.randint(5, 250))) for i in range(500)}
    many, few = licenses.Scanner(templates, 0.8), licenses.Scanner(licenses.TEMPLATES, 0.8)
    for name in rng.sample(sorted(templates), 25):
        w = templates[name].split()
        if len(w) > 60:
            w[rng.randrange(len(w))] = "changed"
        text = " ".join([word() for _ in range(50)] + w + [word() for _ in range(50)])
        assert [m[0] for m in many.scan(text)] == list(brute_licenses(text, templates)) == [name]
    texts = [" ".join(word() for _ in range(400)) for _ in range(200)]
    took = {}
    for key, scanner in (("few", few), ("many", many), ("few", few), ("many", many)):
        start = time.process_time()
        assert not any(map(scanner.scan, texts))
        took[key] = time.process_time() - start
    assert took["many"] < 3 * took["few"]


def test_long_text_is_scanned_whole():
    s = licenses.Scanner(licenses.TEMPLATES, 0.8)
    pad = " ".join(f"w{i}" for i in range(100_000))
    for cut in (99_990, 99_998, 100_000):
        w = pad.split()[:cut] + licenses.TEMPLATES["MIT-notice"].split() + ["tail"] * 50
        assert [m[0] for m in s.scan(" ".join(w))] == ["MIT-notice"]


def test_pieces_equal_the_library():
    import sentencepiece

    path = pieces.default_model()
    sp, enc = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Encoder(path)
    rng = random.Random(3)
    texts = ["", "a", " ", "  ", " hello   world \n x\t é😀 ", "x" * 3000, "=" * 77, "-" * 40 + " " * 37 + "#" * 20, "日本語テキスト", "<s> <0x41> </s>"]
    texts += ["".join(rng.choice("tehinaorsd") for _ in range(rng.randint(1, 600))) for _ in range(60)]
    texts += ["".join(rng.choice("the in on er s t a é\n   ") for _ in range(300)) for _ in range(60)]
    texts += ["".join(chr(rng.randint(1, 0x2FFF)) for _ in range(300)) for _ in range(5)]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == sp.encode(t), t[:50]
        if "▁" not in t:
            assert enc.model.decode(ids.tolist()) == t


def write_vocabulary(path, pieces, kind, byte_fallback=False):
    """A vocabulary file put together by hand: pieces (text, score, type), nothing trained."""
    def field(n, value):
        if isinstance(value, int):
            return number(n << 3) + number(value)
        if isinstance(value, float):
            return number(n << 3 | 5) + struct.pack("<f", value)
        return number(n << 3 | 2) + number(len(value)) + value

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes((n & 127 | 128,)), n >> 7
        return out + bytes((n,))

    out = b"".join(field(1, field(1, t.encode()) + field(2, float(s)) + field(3, k)) for t, s, k in pieces)
    out += field(2, field(3, kind) + (field(35, 1) if byte_fallback else b""))
    out += field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    path.write_bytes(out)


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_unigram_paths_equal_the_library(tmp_path, byte_fallback):
    import sentencepiece

    rng = random.Random(5)
    pieces_of = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces_of += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    texts_of = {"\u2581"} | set("abcde")
    while len(texts_of) < 120:
        texts_of.add(rng.choice(("", "\u2581")) + "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))))
    pieces_of += [(t, -rng.randint(64, 768) / 64, 1) for t in sorted(texts_of)]  # sums are exact, so equal paths are equal
    path = tmp_path / "unigram.model"
    write_vocabulary(path, pieces_of, 1, byte_fallback)
    sp, enc = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.Encoder(str(path))
    assert enc.model.unigram and not pieces.Encoder(pieces.default_model()).model.unigram
    texts = ["", " ", "abc", "zz", "a z b", "zzabzz  zz", "  abcde ", "é"] + ["".join(rng.choice("abcde  z") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["abcde" * 300]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids.tolist() == sp.encode(t), t


def test_topk(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(300, 24)), np.repeat(rng.normal(size=(3, 24)), 20, axis=0)]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(t) for t in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(df, df.filter("vec_id % 7 = 0"), 10).collect()}
    y = np.floor(x.astype(np.float64) * 1024).astype(np.int64)
    for q in range(0, len(x), 7):
        s = y @ y[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:10]
        assert [got[q, r + 1] for r in range(10)] == [(i, s[i]) for i in order]


@pytest.mark.parametrize("lengths", [(24,), (24, 5, 0)])
def test_topk_in_many_parts_and_blocks(spark, lengths, monkeypatch):
    monkeypatch.setattr(topk, "PART", (20, 60))
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "SAMPLE", 15)
    rng = np.random.default_rng(len(lengths))
    rows = [(i // 2, [float(x) for x in np.float32(rng.normal(size=rng.choice(lengths)))]) for i in range(300)]
    rows += [(i, rows[3][1]) for i in range(400, 460)]  # copies: ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 5 = 0")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(df, asked, 4).collect())
    want = []
    y = [(i, [math.floor(1024 * x) for x in v], v) for i, v in rows]
    for q in sorted({i for i, _ in rows if i % 5 == 0}):
        _, e, _ = min((x for x in y if x[0] == q), key=lambda x: x[2])
        best = sorted((-sum(a * b for a, b in zip(e, c)), i) for i, c, _ in y if i != q and len(c) == len(e))[:4]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == want


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_profiles_equal_their_definition():
    p = langid.Profiles(64)
    v = {c: p.of_letter(ord(c) if c != " " else 0).astype(int) for c in " abé"}
    want = sum(np.roll(v[a], 2) * np.roll(v[b], 1) * v[c] for a, b, c in (" ab", "abé", "bé ", " a "))
    assert (p.bundle(["Ab\u00c9 -- a"])[0] == want).all()


def plain_profile(text, letters, dim):
    """The sum of a text's trigrams, one after the other; None without a letter."""
    out, chars = np.zeros(dim), [0]
    for c in (text or "").lower():
        c = ord(c) if c.isalpha() else 0
        if c or chars[-1]:
            chars.append(c)
    chars += [0] * (chars[-1] != 0)
    for a, b, c in zip(chars, chars[1:], chars[2:]):
        if b:
            out += np.roll(letters(a), 2) * np.roll(letters(b), 1) * letters(c)
    return out if out.any() else None


def plain_languages(rows, dim=langid.DIM):
    """rows (doc_id, text, lang) -> (doc_id -> (best, cosine)), with prototypes from rows that have a lang and are not held out."""
    letters = functools.cache(langid.Profiles(dim).of_letter)
    profile = {d: plain_profile(t, letters, dim) for d, t, _ in rows}
    protos = {}
    for d, t, lang in rows:
        if lang is not None and t is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            p = profile[d]
            protos[lang] = protos.get(lang, 0) + (p / np.linalg.norm(p) if p is not None else 0)
    protos = {k: v / np.linalg.norm(v) for k, v in protos.items()}
    out = {}
    for d, p in profile.items():
        cos = {k: float(p @ v / np.linalg.norm(p)) for k, v in protos.items()} if p is not None else {}
        best = min(cos, key=lambda k: (-cos[k], k), default="und")
        out[d] = (best, cos.get(best, 0.0))
    return out


def test_languages_by_the_definition(spark, docs):
    rows = [(r.doc_id, r.text[:1500], r.lang) for r in docs.limit(80).collect()] + [(9001, None, "en"), (9002, "12 !", "de"), (9003, "Ägypten ist weit", None), (9004, "日本語の文 日本", "ja")]
    want = plain_languages(rows)
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got.keys() == want.keys()
    for d, (best, cos) in want.items():
        assert got[d].lang_pred == best and got[d].score == pytest.approx(max(0, cos), abs=1e-4)


def test_profiles_of_a_very_long_text(monkeypatch):
    """10 MB of mostly different CJK trigrams: exact against small pieces, and memory stays bounded."""
    rng = np.random.default_rng(2)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 3_400_000)))
    assert len(text.encode()) > 10_000_000
    p = langid.Profiles(32)
    tracemalloc.start()
    whole = p.bundle([text, "short text"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150_000_000 and len(p.place) <= langid.ROOM
    c = np.array([ord(x) for x in text[:5000]])
    want = sum(np.roll(p.of_letter(a), 2).astype(int) * np.roll(p.of_letter(b), 1) * p.of_letter(d) for a, b, d in zip([0, *c], c, [*c[1:], 0]))
    assert (p.bundle([text[:5000]])[0] == want).all()
    monkeypatch.setattr(langid, "PIECE", 1000)
    monkeypatch.setattr(langid, "SLICE", 64)
    assert np.array_equal(langid.Profiles(32).bundle([text[:200_000], "short text"]), langid.Profiles(32).bundle([text[:200_000], "short text"]))
    assert np.array_equal(p.bundle(["short text"])[0], whole[1])


def plain_pipeline(rows):
    """All five stages one after the other in plain Python: [(doc_id, text)] of the rows that come out."""
    lang = plain_languages([(d, t, g) for d, t, g, _ in rows])
    rows = [r for r in rows if lang[r[0]][0] != "und" and lang[r[0]][1] >= 0.1]
    sets = []
    for _, t, _, _ in rows:
        w = t.encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    near = {(a, b) for own in by_shingle.values() for a, b in itertools.combinations(own, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    root = components(len(rows), lambda a, b: (a, b) in near)
    ids = {i: rows[i][0] for i in range(len(rows))}
    least = {c: min(ids[i] for i in ids if root[i] == c) for c in root}
    rows = sorted(r for i, r in enumerate(rows) if r[0] == least[root[i]])
    rows = [(d, kept if gone else t, s) for (d, t, _, s), (_, gone, kept) in zip(rows, brute_removals([r[1] for r in rows], 50)) if kept or not gone]
    copies = brute_copies([(d, len(t.split()), s) for d, t, s in rows])
    return [(d, t) for d, t, s in rows for _ in range(copies[d, len(t.split()), s])]


def test_pipeline(spark, tmp_path):
    """All stages against plain ones, on documents with copies, near copies on both sides of 0.8, shared passages and junk."""
    import sentencepiece

    rng = random.Random(21)
    rows = [(r.doc_id, " ".join(r.text.split()[:400]), r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(90).collect()]
    n = 10_000
    for d, t, lang, source in rows[:30]:
        w = t.split()
        for share in (0, 0.01, 0.02, 0.05):
            v = [rng.choice(w) + "x" if rng.random() < share else x for x in w]
            n += 1
            rows.append((n, " ".join(v), lang, source))
    passage = " ".join(f"common{i}" for i in range(70))
    rows += [(n + i, f"{rows[i][1]} {passage} {rows[i + 3][1][:200]}", "en", f"s{i % 3}") for i in range(1, 12)]
    rows += [(n + 50, "1234 5678", "en", "s1"), (n + 51, "", None, None), (n + 52, None, "en", "s0")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.same for r in out)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    got = sorted((r.doc_id, tuple(r.ids)) for r in out)
    want = sorted((d, tuple(sp.encode(t))) for d, t in plain_pipeline(rows))
    assert got == want
