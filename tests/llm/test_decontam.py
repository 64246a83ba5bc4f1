import random

from pagewright.llm import decontam as D
from pagewright.llm.queries import op8_decontam


def items_of(n, seed):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(40)], [f"r{i}x" for i in range(3000)]
    say = lambda k: " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(k)).capitalize() + "."
    return [(i, f"{say(rng.randint(10, 40))} {say(rng.randint(1, 12))}") for i in range(n)], common, rare, rng


def brute(index, terms):
    score = {}
    for t in terms:
        for place, w in index.postings[t]:
            score[place] = score.get(place, 0) + w
    return sorted(p for p, s in score.items() if s >= index.threshold - 1e-9)


def test_wand_equals_brute_force():
    rows, *_, rng = items_of(120, 1)
    index, hits = D.Index(rows, 0.5, 0.2), 0
    for _ in range(1500):
        own = rng.choice(index.items).terms
        terms = sorted(set(rng.sample(own, int(len(own) * rng.uniform(0.3, 1)))) | set(rng.choices(range(len(index.ids)), k=40)))
        want = brute(index, terms)
        hits += len(want)
        assert index.above(terms) == want
    assert hits > 300


def slow_leaks(index, text):
    """Every passage scored against every item, without any bound."""
    terms = [index.ids.get(t, -1) for t in D.terms_of(text or "")]
    found = set()
    for a in range(0, max(1, len(terms)), index.stride):
        own = terms[a : a + 2 * index.stride]
        for place in brute(index, {t for t in own if t >= 0}):
            if index.verified(place, own):
                found.add(index.items[place].item_id)
    return sorted(found)


def test_operator_equals_brute_force(spark):
    rows, common, rare, rng = items_of(60, 2)
    rows += [(60, None), (61, "..."), (62, rows[3][1])]
    docs = [(None, None), (1, ""), (2, rows[5][1].upper().replace(" ", "%%% ")), (2, rows[5][1])]
    for d in range(3, 120):
        words = [rng.choice(common + rare) for _ in range(rng.choice((5, 300, 900)))]
        for _ in range(rng.randint(0, 2)):
            leak = rng.choice(rows[:60])[1].split()
            for _ in range(rng.choice((0, 0, 1, 6))):
                leak[rng.randrange(len(leak))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = leak
        docs.append((d, " ".join(words)))
    docs.append((500, "c1 c2 " * 30_000 + rows[9][1] + " c3" * 500))
    index = D.Index([r for r in rows if r[1]], 0.6, 0.3)
    frame = spark.createDataFrame([(*d, "own") for d in docs], "doc_id long, text string, item_ids string").repartition(3)
    bench = spark.createDataFrame(rows, "item_id long, text string")
    want = sorted((str(d), slow_leaks(index, t)) for d, t in docs)
    assert sorted((str(r.doc_id), r.item_ids) for r in D.find_leaks(spark, frame, bench).collect()) == want
    assert sum(bool(x) for _, x in want) > 40 and dict(want)["500"] == [9] and dict(want)["None"] == []
    parts = D.find_leaks(spark, frame, bench, index_bytes=3000).collect()
    assert {str(r.doc_id) for r in parts if r.item_ids} >= {"500", "2"}
    assert not any(r.item_ids for r in D.find_leaks(spark, frame, bench.where("false")).collect())
    assert D.find_leaks(spark, frame.where("false"), bench).collect() == []


def test_several_passes_equal_one(spark):
    rows, common, rare, rng = items_of(80, 3)
    docs = []
    for d in range(600):
        item = rng.choice(rows)[1].split()
        start = rng.choice((0, 0, rng.randint(0, len(item) // 5)))
        kept = item[start : start + round(len(item) * rng.uniform(0.78, 1))]
        docs.append((d, " ".join(rng.choices(common + rare, k=rng.choice((3, 150))) + kept + rng.choices(common, k=100))))
    # A long item in one part sets the length of passages in all.
    rows.append((80, " ".join(rng.choices(rare, k=200))))
    bench, frame = spark.createDataFrame(rows, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    one, several = ({r.doc_id: r.item_ids for r in D.find_leaks(spark, frame, bench, threshold=0.8, index_bytes=n).collect()} for n in (1 << 20, 7000))
    assert several == one and 200 < sum(map(bool, one.values())) < 600


def test_whole_table_finds_verbatim_items(spark):
    sf = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: set(r.item_ids) for r in op8_decontam(spark, sf).collect()}
    assert len(got) == len(docs)
    verbatim = {d: {i for i, x in items if x in t} for d, t in docs}
    assert all(verbatim[d] <= got[d] for d in got)
    assert sum(map(len, got.values())) <= 1.1 * sum(map(len, verbatim.values())) + 2


def test_short_items_match_whole_texts_alone(spark):
    rows = [(1, "Yes."), (2, "Of course, no."), (3, "yes"), (4, "one two three four five.")]
    docs = [(1, "Yes, this text says yes."), (2, "*Yes!*"), (3, "of course no"), (4, "of course no more"), (5, "x one two three four five y"), (5, None)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    frame = spark.createDataFrame([(*d, 7, 8) for d in docs], "doc_id long, text string, rid int, row int")
    for n in (1 << 20, 10):
        got = D.find_leaks(spark, frame, bench, index_bytes=n).collect()
        assert sorted((r.doc_id, r.text or "", r.item_ids) for r in got) == [(1, docs[0][1], []), (2, docs[1][1], [1, 3]), (3, docs[2][1], [2]), (4, docs[3][1], []), (5, "", []), (5, docs[4][1], [4])]
        assert all((r.rid, r.row) == (7, 8) for r in got)


def test_an_index_takes_a_bounded_share_of_its_items():
    """2 MB of items, measured in a process of its own."""
    import subprocess
    import sys

    code = """
import random, resource
from pagewright.llm import decontam as D
rng = random.Random(1)
words = [f"w{rng.randrange(10**7)}" for _ in range(40_000)]
rows = [(i, " ".join(rng.choices(words, k=50)) + ". " + " ".join(rng.choices(words, k=5))) for i in range(5000)]
size = sum(len(t) for _, t in rows)
assert size > 1_900_000
D.Index(rows[:100], 0.6, 0.3)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
index = D.Index(rows, 0.6, 0.3)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 / size)
"""
    assert float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 20
