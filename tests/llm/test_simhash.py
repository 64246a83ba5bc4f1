import random

import numpy as np
import xxhash

from pagewright.llm import simhash
from pagewright.llm.components import connected_components
from pagewright.llm.queries import op7_simhash


def brute_fp(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, threshold):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= threshold:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_many_hashes_equal_the_library():
    from pagewright.llm import xxh64

    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 60_000, dtype=np.uint8)
    lengths = np.concatenate([np.arange(0, 400), rng.integers(0, 100, 3000), [4095, 4096, 4097, 20_000]])
    starts = np.array([rng.integers(0, len(data) - n + 1) for n in lengths])
    starts[:3], lengths[:3] = (len(data), len(data) - 3, len(data) - 33), (0, 3, 33)
    for seed in (0, 42, 2**64 - 1):
        want = [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), seed) for a, n in zip(starts, lengths, strict=True)]
        assert xxh64.hashes(data, starts, lengths, seed).tolist() == want
    assert len(xxh64.hashes(data[:0], starts[:0], lengths[:0], 42)) == 0


def test_fingerprints_of_odd_texts(monkeypatch):
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["", " ", "a", "A b", "a b c d", " a\tb\x0bc\x0cd\re\n", "É À\x85 b\xa0c d e", "x" * 9000 + " y", "a b c d " * 3000, "\x1c\x1d w"]
    texts += ["".join(rng.choice("abAB é\n\t0") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    want = [signed(brute_fp(t)) for t in texts]
    whole = pa.array(["cut off", *texts])
    assert simhash.fingerprints_of(whole[1:], 4).tolist() == want
    monkeypatch.setattr(simhash, "BITS_ROWS", 7)
    assert simhash.fingerprints_of(pa.array(texts), 4).tolist() == want
    assert simhash.fingerprints_of(pa.array([], pa.string()), 4).tolist() == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    fps = [brute_fp(t) for _, t in docs]
    comps = brute_components(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op7_simhash(spark, sf).collect()}
    assert got == {d: (f"{f:016x}", docs[c][0]) for (d, _), f, c in zip(docs, fps, comps)}


def test_anchors_meet():
    rng, masks = random.Random(3), simhash.anchor_masks(2)
    around = lambda x: {int(x ^ m) for m in masks[simhash.syndromes(np.array([x]))[0]] if m >= 0}
    for _ in range(2000):
        x = rng.getrandbits(32)
        y = x
        for bit in rng.sample(range(32), rng.randint(0, 2)):
            y ^= 1 << bit
        assert around(x) & around(y)
        assert len(around(x)) <= 17


def test_links_with_clusters_and_blocks(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        c = rng.getrandbits(64)
        for _ in range(rng.choice((1, 3, 120))):
            x = c
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << bit
            fps.add(x)
    fps = [0, (1 << 64) - 1, *sorted(fps - {0})]
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    want = brute_components(fps, 4)
    for block in (4096, 16):
        links = simhash.near_links(spark, frame, 4, block)
        assert all((a ^ b).bit_count() <= 4 for a, b in links.collect() for a, b in [(a & (1 << 64) - 1, b & (1 << 64) - 1)])
        root = {r.node: r.root for r in connected_components(spark, links).collect()}
        label = [root.get(signed(f), signed(f)) for f in fps]
        assert len({(a, b) for a, b in zip(label, want)}) == len(set(label)) == len(set(want))


def test_a_hot_anchor_is_dealt_by_its_other_half(spark, monkeypatch):
    """Fingerprints that share a half meet at all of its anchors; pieces of the other half keep every link, without pairs of blocks."""
    rng, fps = random.Random(12), set()
    for _ in range(300):
        x = (rng.getrandbits(32) << 32) | 0x12345678
        fps.add(x)
        for _ in range(rng.choice((0, 0, 1, 3))):
            y = x
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << bit
            fps.add(y)
    fps = sorted(fps)
    swapped = [((f & 0xFFFFFFFF) << 32) | f >> 32 for f in fps]
    monkeypatch.setattr(simhash, "in_blocks", lambda over, block: 1 / 0)
    for own in (fps, swapped):
        links = simhash.near_links(spark, spark.createDataFrame([(signed(f),) for f in own], "fp long").repartition(3), 4, 100)
        root = {r.node: r.root for r in connected_components(spark, links).collect()}
        label, want = [root.get(signed(f), signed(f)) for f in own], brute_components(own, 4)
        assert len(set(zip(label, want, strict=True))) == len(set(label)) == len(set(want)) < len(own)


def test_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 400)] + [(None, 3), (7, 7), (1, 0)]
    root = {r.node: r.root for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert root == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 400)}}


def test_nulls_and_empty(spark):
    schema = "doc_id long, text string, fp string, component_id string"
    assert simhash.near_duplicates(spark, spark.createDataFrame([], schema)).collect() == []
    rows = [(5, None), (3, " \n"), (None, "a b c"), (None, "a b c"), (9, "A B\tC"), (4, "w " * 50_000), (4, "w " * 50_000)]
    got = simhash.near_duplicates(spark, spark.createDataFrame([(*r, "x", "y") for r in rows], schema)).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == sorted([("5", 3), ("3", 3), ("None", 9), ("None", 9), ("9", 9), ("4", 4), ("4", 4)])
    assert {r.fp for r in got if r.component_id == 3} == {0}
