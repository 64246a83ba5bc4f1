import numpy as np

from pagewright.llm import cotrain
from pagewright.llm.queries import op3_cotrain


def test_accuracy_on_labels_kept_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 2) = 0")
    model = cotrain.fit(docs, train.select("doc_id", "quality"), limits=cotrain.Limits(labelled=1000))
    rows = cotrain.score(docs, model).join(labels.subtract(train), "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert len(rows) > 1000 and sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = op3_cotrain(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= p <= 1 for r in rows for p in (r.p_text, r.p_meta, r.score))


def test_a_view_that_tells_nothing_adds_nothing():
    rng = np.random.default_rng(1)
    y = (rng.random(2000) < 0.8).astype(float)
    noise, signal = rng.normal(size=2000), 3 * y + rng.normal(size=2000)
    a, b = cotrain.platt(noise, y)
    assert np.allclose(a * noise + b, np.log(0.8 / 0.2), atol=0.35)
    a, b = cotrain.platt(signal, y)
    p = 1 / (1 + np.exp(-(a * signal + b)))
    assert abs(p.mean() - y.mean()) < 0.02


def test_every_row_outside_the_sample_may_teach(spark):
    """Every document has a label; those outside the sample are the pool, and all that are sure enough are counted."""
    rng = np.random.default_rng(2)
    quality = [int(rng.random() < 0.5) for _ in range(6000)]
    text = [" ".join(rng.choice(["fine", "good", "word"] if q else ["spam", "junk", "word"], 8)) for q in quality]
    docs = spark.createDataFrame([(i, t, "en", f"site{q}") for i, (t, q) in enumerate(zip(text, quality, strict=True))], "doc_id long, text string, lang string, source string").repartition(3)
    labels = spark.createDataFrame(list(enumerate(quality)), "doc_id long, quality int")
    model = cotrain.fit(docs, labels, limits=cotrain.Limits(labelled=400, rounds=1, share=1.0, fit_rows=500))
    last = [h for h in model.history if h["round"] == 1]
    assert {h["view"] for h in last} == {"text", "meta"}
    # A share of 1 reaches into every row of the pool; the fit reads a sample of about 500.
    assert all(sum(h["given"].values()) > 5000 and 300 < h["sampled"] < 800 for h in last)


def test_both_views_teach_each_other(spark, monkeypatch):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    features = cotrain.features_of(docs)
    model, alone = (cotrain.fit_features(features, labels, limits=cotrain.Limits(rounds=k)) for k in (2, 0))
    last = {h["view"]: h for h in model.history if h["round"] == 2}
    assert all(h["given"][0] > 50 and h["given"][1] > 500 and h["sampled"] > 500 for h in last.values())
    assert all(h["accuracy"] > 0.95 for h in model.history)
    # Without the exchange the verdicts are others.
    rows = cotrain.score_features(features, model).select("doc_id", "p_text", "p_meta").join(
        cotrain.score_features(features, alone).selectExpr("doc_id", "p_text AS t", "p_meta AS m"), "doc_id"
    )
    assert rows.where("abs(p_text - t) > 0.01").count() > 100 and rows.where("abs(p_meta - m) > 0.01").count() > 100


def slow_views(text, source, lang):
    """Both views of a document as dense vectors, a word and a character at a time."""
    import math
    import re
    import zlib

    crc, words, data = lambda x: zlib.crc32(x.encode()), (text or "").split(), (text or "").encode()
    t, m = np.zeros(cotrain.TextView.width + cotrain.RATIOS), np.zeros(cotrain.META)
    for w in words:
        kinds = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in w)
        t[crc(w) % cotrain.WORDS] += 1 / len(words)
        t[cotrain.WORDS + crc(re.sub(r"(.)\1+", r"\1", kinds)) % cotrain.SHAPES] += 1 / len(words)
    n, distinct, letters = len(words), len(set(words)), sum(map(len, words))
    size = max(1, n)
    t[-6:] = [math.log1p(n) / 10, distinct / size, math.sqrt(size) * (1 - distinct / size) / 20, letters / size / 10, float(n < 20), letters / max(1, len(data))]
    m[crc(f"source={source}") % 512] = m[512 + crc(f"lang={lang}") % 64] = m[576 + len(data).bit_length()] = 1
    lines = data.count(b"\n") + 1
    is_mark = lambda c: c < 128 and not chr(c).isalnum() and not chr(c).isspace()
    shares = [sum(map(f, data)) / max(1, len(data)) for f in (lambda c: 65 <= c < 91, lambda c: 48 <= c < 58, is_mark, lambda c: c < 128 and chr(c).isspace() and c != 10, lambda c: c > 127)]
    for k, x in enumerate([min(15, lines.bit_length()), min(15, (len(data) // lines).bit_length()), *(int(15.999 * math.sqrt(x)) for x in shares)]):
        m[608 + 16 * k + x] = 1
    return t, m


def slow_fit(x, y, weight, decay):
    """Adam over the whole of dense ``x``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, first, second, keep = np.zeros(x.shape[1]), 0, 0, np.append(np.full(x.shape[1] - 1, decay), 0)
    for k in range(1, 81):
        g = x.T @ ((1 / (1 + np.exp(-x @ w)) - y) * weight / weight.sum()) + keep * w
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w = w - 0.3 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return lambda z: z @ w[:-1] + w[-1]


def test_fit_and_scores_equal_brute_force(spark):
    import math
    import zlib

    rng = np.random.default_rng(11)
    docs, quality = [], {}
    for i in range(260):
        q = int(rng.random() < 0.7)
        words = rng.choice(["fine", "Good", "word", "été", "and"] if q else ["SPAM", "ju$$nk", "word", "9999", "and"], rng.integers(1, 40))
        docs.append((i, " ".join(words) + ("\n" * int(rng.integers(0, 3))), str(rng.choice(["en", "de"])), f"s{rng.integers(0, 4)}" if rng.random() < 0.9 else None))
        if i < 130:
            quality[i] = q if rng.random() < 0.95 else 1 - q
    docs += [(300, None, None, None), (301, "", "en", "s1"), docs[200], (None, "fine Good", "en", "s1")]
    limits = cotrain.Limits(labelled=10**6, fit_rows=10**6, share=0.3)
    frame = spark.createDataFrame([(*d, "own", 1) for d in docs], "doc_id long, text string, lang string, source string, rid string, size int").repartition(3)
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    model = cotrain.fit(frame, labels, limits=limits)
    got = sorted((str(r.doc_id), r.p_text, r.p_meta, r.score) for r in cotrain.score(frame, model).collect())

    views = {name: np.array(x) for name, x in zip(("text", "meta"), zip(*(slow_views(t, s, la) for _, t, la, s in docs), strict=True), strict=True)}
    known = [k for k, d in enumerate(docs) if d[0] in quality]
    pool = [k for k, d in enumerate(docs) if d[0] not in quality]
    back = [k for k in known if zlib.crc32(f"back{docs[k][0]}".encode()) % 1000 < 250]
    train = [k for k in known if k not in back]
    truth = lambda ks: np.array([float(quality[docs[k][0]]) for k in ks])
    base, taught, odds = truth(known).mean(), {"text": [], "meta": []}, {}
    for number in (0, 1, 2):
        for name, x in views.items():
            extra = taught[name]
            raw = slow_fit(x[train + [k for k, _ in extra]], np.append(truth(train), [float(c) for _, c in extra]), np.append(np.ones(len(train)), np.full(len(extra), 0.25)), 1e-4 if name == "text" else 1e-3)
            a, b = cotrain.platt(raw(x[back]), truth(back))
            odds[name] = a * raw(x) + b
        taught = {"text": [], "meta": []}
        for name, other in (("text", "meta"), ("meta", "text")):
            for c, part in ((0, 1 - base), (1, base)):
                own = odds[name] if c else -odds[name]
                step = {k: math.floor(min(own[k], 31.999) * 64) for k in pool if own[k] >= math.log(9)}
                ordered, take = sorted(set(step.values()), reverse=True), []
                for s in ordered:
                    more = [k for k in step if step[k] == s]
                    if take and len(take) + len(more) > (number + 1) * 0.3 * part * len(pool):
                        break
                    take += more
                taught[other] += [(k, c) for k in take]
    chance = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    want = sorted((str(d[0]), *x) for d, x in zip(docs, zip(chance(odds["text"]), chance(odds["meta"]), chance(odds["text"] + odds["meta"] - math.log(base / (1 - base))), strict=True), strict=True))
    assert [x[0] for x in got] == [x[0] for x in want]
    assert np.allclose([x[1:] for x in got], [x[1:] for x in want], atol=2e-3)
    assert all(h["sampled"] > 10 for h in model.history if h["round"])


def test_whole_shapes_count():
    assert cotrain.shape("aaB1-b2-c3-dé.EE") == "xX9-x9-x9-x.X"


def test_nulls_single_class_and_empty(spark):
    schema = "doc_id long, text string, lang string, source string, score string"
    docs = spark.createDataFrame([(1, None, None, None, "x"), (None, "a b", "en", "s", "x"), (2, "w " * 100_000, "en", "s", "x"), (2, "", "en", "s", "x")], schema)
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (9, 0), (3, None)], "doc_id long, quality int")
    for few, want in ((labels, 1.0), (labels.where("false"), 0.5)):
        rows = cotrain.score(docs, cotrain.fit(docs, few)).collect()
        assert len(rows) == 4 and all(abs(r.score - want) < 1e-6 for r in rows)
    assert cotrain.score(docs.where("false"), cotrain.fit(docs.where("false"), labels)).collect() == []
