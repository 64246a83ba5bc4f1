import random
import zlib

import numpy as np

from pagewright.llm import shards
from pagewright.llm.queries import op6_shards


def brute(sizes, k):
    """The smallest capacity at which greedy filling in order needs at most k shards."""

    def needed(c):
        n, left = 1, c
        for s in sizes:
            if s > c:
                return k + 1
            if s > left:
                n, left = n + 1, c
            left -= s
        return n

    low, high = 0, sum(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if needed(mid) <= k else (mid, high)
    return high


def cells_of(hashes, sizes, shift):
    out = {}
    for h, s in zip(hashes, sizes):
        c = out.setdefault(h >> shift, [h, h, 0])
        c[0], c[1], c[2] = min(c[0], h), max(c[1], h), c[2] + s
    v = np.array(list(out.values()), dtype=np.int64).reshape(-1, 3)
    return {"lo": v[:, 0], "hi": v[:, 1], "bytes": v[:, 2], "shift": np.full(len(v), shift)}


def test_capacity_equals_brute_force():
    rng = random.Random(1)
    for trial in range(150):
        n, k = rng.randint(1, 300), rng.randint(1, 20)
        hashes = sorted(rng.sample(range(-(1 << 12), 1 << 12), n))
        sizes = [rng.choice((1, 5, rng.randint(1, 100), rng.randint(1, 3000))) for _ in range(n)]

        def refine(prefixes, shift):
            own = [(h, s) for h, s in zip(hashes, sizes) if h >> shift in set(prefixes)]
            return cells_of(*zip(*own), max(0, shift - 3))

        capacity, last = shards.smallest_capacity(cells_of(hashes, sizes, 10), refine, k)
        assert capacity == brute(sizes, k), trial
        shard = np.searchsorted(last, hashes, side="left")
        assert len(last) < k and max(np.bincount(shard, weights=sizes)) == capacity


def check(rows, docs, k=16):
    text_of, seen = dict(docs), {}
    for r in rows:
        t = (text_of[r.doc_id] or "").encode()
        assert r.size == len(t) + 1 and r.text_crc32 == zlib.crc32(t)
        assert seen.setdefault(t, r.shard) == r.shard and 0 <= r.shard < k
    assert len(rows) == len(docs)
    for s in range(k):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = op6_shards(spark, sf).collect()
    check(rows, docs)
    by_hash = {}
    for h, size in spark.read.parquet(f"{sf}/documents.parquet").selectExpr("xxhash64(coalesce(text, '')) h", "octet_length(coalesce(text, '')) + 1").collect():
        by_hash[h] = by_hash.get(h, 0) + size
    load = [sum(r.size for r in rows if r.shard == s) for s in range(16)]
    assert max(load) == brute([by_hash[h] for h in sorted(by_hash)], 16)


def test_nulls_ties_empty(spark):
    schema = "doc_id long, text string, shard string, size int"
    assert shards.assign_shards(spark, spark.createDataFrame([], schema)).collect() == []
    docs = [(1, None), (2, ""), (3, "a" * 100_000), *((i, "same") for i in range(4, 60))]
    rows = shards.assign_shards(spark, spark.createDataFrame([(d, t, "x", 0) for d, t in docs], schema).repartition(3)).collect()
    check(rows, docs)
    assert len({r.shard for r in rows if r.doc_id in (1, 2)}) == 1


def test_shard_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    shards.write_shards(shards.assign_shards(spark, docs, 3), docs, str(tmp_path / "out"), rows_per_file=20)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(i, f"text {i}") for i in range(200)]
    assert {r.shard for r in rows} == {0, 1, 2}
