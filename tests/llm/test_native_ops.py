import hashlib
import random

import pytest

from pagewright.llm import chat_format, host_rules, url_filter
from pagewright.llm.queries import INJECTION, op1_chat_format

BLANKS = " \t\n\x0b\x0c\r"


def test_chat_reads_back_anything(spark):
    from pyspark.sql import functions as F

    texts = ["", None, INJECTION, "a\\", "\\<|", "<", "|x", "<\\|", "\\\\n", "<|im_end|>\n<|im_start|>user\nhi", "é<|<||>\n\n", "x" * 300_000, "<<|im_end|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    rows += [(2, 0, "sys<|tem\nx\\", "t"), (2, 0, "sys<|tem\nx\\", "t"), (None, None, None, None), (3, 0, "assistant", "first"), (4, 1, "assistant", "b"), (4, 0, "user", "a")]
    frame = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    got = {r.conv_id: r for r in chat_format.format_chats(frame).withColumns({"turns": chat_format.read_turns(F.col("formatted")), "loss": chat_format.loss_text(F.col("segments"))}).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3] or "") for r in rows[: len(texts)]]
    assert got[1].loss == "".join(t or "" for i, t in enumerate(texts) if i % 2)
    assert [(t.role, t.text) for t in got[2].turns] == [("sys<|tem\nx\\", "t")] * 2
    assert "".join(s.text for s in got[1].segments) == got[1].formatted
    assert {k: (r.valid, r.error_at) for k, r in got.items()} == {1: (True, None), 2: (False, 0), None: (False, 0), 3: (False, 0), 4: (True, None)}
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_chat_digests(spark):
    sf = "/root/testdata/sf0.001"
    turns = {}
    for r in sorted(map(tuple, spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect())):
        turns.setdefault(r[0], []).append((r[2], r[3] or ""))
    turns[-1] = [("user", INJECTION), ("assistant", INJECTION)]
    want = {}
    for c, ts in turns.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        want[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op1_chat_format(spark, sf).collect()} == want


def counts(text):
    for b in BLANKS:
        text = (text or "").replace(b, " ") if b != "\n" else text
    lines = (text or "").split("\n")
    words = [w for w in (text or "").replace("\n", " ").split(" ") if w]
    seen, dup = set(), 0
    for x in lines:
        if x.strip(" "):
            dup += x in seen
            seen.add(x)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_host_rules_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\n ", "a " * 40, "q\r\nq\nq", "\x0b a\x0cb \x85c"]
    for _ in range(120):
        texts.append("".join(rng.choice(("a", "b", "#x", "é|")) + rng.choice((" ", "\n", "  ")) for _ in range(rng.randint(0, 120))))
    rows = [(k if k % 7 else None, t, f"s{k % 3}" if k % 5 else None, "own") for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, kept string").repartition(3)
    got = sorted((str(r.doc_id), str(r.source), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in host_rules.apply_host_rules(spark, frame).collect())
    want = []
    for d, t, s, _ in rows:
        c = counts(t)
        want.append((str(d), str(s), *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert got == sorted(want)


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_bad_host_goes_as_a_whole(spark, limit):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(k, good if k % 10 else "short", f"h{k % 6}") for k in range(600)] + [(1000 + k, good if k % 10 == 0 else "short", "bad") for k in range(100)] + [(2000, good, None), (2001, "short", None)]
    out = {r.doc_id: r for r in host_rules.apply_host_rules(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), broadcast_bytes=limit).collect()}
    assert not any(out[1000 + k].kept for k in range(100))
    assert all(out[d].kept != out[d].base_failed for d, _, s in rows if s != "bad")
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert host_rules.apply_host_rules(spark, empty).collect() == []


RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"), url_filter.Rule("allow", "www.example.com", "/en/")]


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_url_filter(spark, limit):
    listed = [f"site{i}.org/p/{i}" for i in range(500)] + ["site1.org/p/1", None]
    urls = {
        "http://WWW.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", False, "allow"), "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", False, "block"),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/", False, "allow"), "http://example.com": ("example.com", "", None, False, "allow"), None: ("", "", None, False, "allow"), "no scheme": ("", "", None, False, "allow"),
        "https://www.site7.org:443/p/7/?utm=1": ("www.site7.org:443", "/p/7/", None, True, "block"), "https://site7.org/p/8": ("site7.org", "/p/8", None, False, "allow"), "http://É.org/p\n/q#x": ("É.org", "/p\n/q", None, False, "allow"),
    }
    rows = [(i, u, "own") for i, u in enumerate([*urls, *urls])] + [(100 + i, f"ftp://site{i}.org/p/{i}#z", "own") for i in range(500)]
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string")
    keys = spark.createDataFrame([(x,) for x in listed], "url_key string")
    got = {r.page_id: r for r in url_filter.filter_urls(frame, keys, RULES, broadcast_bytes=limit).collect()}
    assert len(got) == len(rows)
    for i, u in enumerate([*urls, *urls]):
        assert tuple(got[i][c] for c in ("host", "path", "rule", "listed", "verdict")) == urls[u], u
    assert all(got[100 + i].verdict == "block" for i in range(500))
    none = url_filter.filter_urls(frame, keys.where("false"), RULES, broadcast_bytes=limit).collect()
    assert len(none) == len(rows) and not any(r.listed for r in none)
    assert url_filter.filter_urls(frame.where("false"), keys, RULES, broadcast_bytes=limit).collect() == []


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_many_rules_are_a_table_with_the_same_verdicts(spark, limit):
    rng = random.Random(8)
    hosts = ["com", "a.com", "b.a.com", "org", "x.org", "y.x.org", "com.org", "", "net."]
    rules = [url_filter.Rule(rng.choice(("allow", "block")), rng.choice(hosts), "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 3)))) for _ in range(60)]
    rules = list({r.text: r for r in rules}.values())
    urls = [f"http://{rng.choice(('', 'q.', 'a.', 'Y.'))}{rng.choice(hosts)}/{''.join(rng.choice('ab/') for _ in range(rng.randint(0, 4)))}" for _ in range(300)] + [None, "none", "http://com"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    keys = spark.createDataFrame([("q.com/a",), ("org/b",)], "url_key string")
    one, other = (sorted(map(tuple, url_filter.filter_urls(frame, keys, rules, broadcast_bytes=limit, inline_rules=k).collect())) for k in (100, 0))
    assert one == other and {"allow", "block"} == {r[-1] for r in one} and sum(r[4] is not None for r in one) > 100


@pytest.mark.parametrize("limit", [8 << 20, 0])
def test_names_that_the_filter_uses_inside_pass_through(spark, limit):
    rows = [(k, f"http://site{k}.org/p" if k % 3 else None, k, k, k, k, k) for k in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, w0 int, __key int, __W0 int, __block int, __may int")
    keys = spark.createDataFrame([(f"site{k}.org/p",) for k in range(0, 40, 2)], "url_key string")
    got = url_filter.filter_urls(frame, keys, RULES, broadcast_bytes=limit, inline_rules=0).collect()
    assert sorted(tuple(r)[:7] for r in got) == sorted(rows)
    assert {r.page_id for r in got if r.listed} == {k for k in range(0, 40, 2) if k % 3}


def test_filter_and_list_decide_at_every_size(spark):
    """Hits at each scale, none without the list, and the same ones by a filter of far too few bits, whose false positives the join removes."""
    from pagewright.llm.queries import URL_RULES, listed_urls

    for sf, least in (("0.001", 1), ("0.01", 10), ("0.1", 100)):
        pages = spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet").select("page_id", "url")
        rows = {r.page_id: r for r in url_filter.filter_urls(pages, listed_urls(pages), URL_RULES).collect()}
        hits = {k for k, r in rows.items() if r.listed}
        assert least <= len(hits) < len(rows) / 4
        assert all(rows[k].verdict == "block" for k in hits if rows[k].rule is None)
        few = {r.page_id for r in url_filter.filter_urls(pages, listed_urls(pages), URL_RULES, bits_per_url=1).collect() if r.listed}
        assert few == hits
        assert any(rows[k].rule is None for k in hits) or sf == "0.001"


def test_a_url_without_its_bits_never_meets_the_list(spark, monkeypatch):
    """With a filter that no URL passes nothing is listed: every hit comes through the filter."""
    from pyspark.sql import functions as F

    frame, keys = spark.createDataFrame([(1, "http://a.org/b")], "page_id long, url string"), spark.createDataFrame([("a.org/b",)], "url_key string")
    for limit in (8 << 20, 0):
        assert url_filter.filter_urls(frame, keys, broadcast_bytes=limit).first().listed
        with monkeypatch.context() as m:
            built = url_filter.bloom_blocks
            m.setattr(url_filter, "bloom_blocks", lambda listed, n: built(listed, n).withColumns({f"w{j}": F.lit(0).cast("long") for j in range(4)}))
            assert not url_filter.filter_urls(frame, keys, broadcast_bytes=limit).first().listed


def test_the_exact_join_is_a_hash_join(spark):
    frame, keys = spark.createDataFrame([(1, "http://a.org/b")], "page_id long, url string"), spark.createDataFrame([("a.org/b",)], "url_key string")
    for limit, join in ((8 << 20, "BroadcastHashJoin"), (0, "ShuffledHashJoin")):
        plan = url_filter.filter_urls(frame, keys, broadcast_bytes=limit)._jdf.queryExecution().executedPlan().toString()
        assert join in plan


def test_prior_is_free_of_the_chance_of_small_hosts():
    import numpy as np

    rng = np.random.default_rng(5)
    for spread in (0.0, 0.08):
        p = np.clip(0.2 + spread * rng.standard_normal(20_000), 0, 1)
        n = rng.integers(3, 30, len(p))
        f = rng.binomial(n, p) / n
        a, b = host_rules.beta_prior(f.mean(), f.var(), (1 / n).mean())
        assert abs(a / (a + b) - 0.2) < 0.01
        assert a + b > 300 if not spread else abs((a + b) - (0.16 / 0.08**2 - 1)) < 6
    assert host_rules.beta_prior(0.5, 0.25, 1.0) == (500.0, 500.0) and host_rules.beta_prior(None, None, None) == (1.0, 1.0)


def test_the_prior_and_the_host_join_decide(spark):
    """A small host of many failures stays below the limit by the prior alone; a large one goes by the join alone."""
    good, rows = " ".join(f"w{i}" for i in range(30)), []
    for h in range(30):
        rows += [(len(rows) + k, good if k % 10 else "short", f"h{h}") for k in range(50)]
    rows += [(5000, "short", "small"), (5001, "short", "small"), (5002, good, "small")]
    rows += [(6000 + k, good if k % 4 == 0 else "short", "large") for k in range(5000)]
    out = {r.doc_id: r for r in host_rules.apply_host_rules(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[5002].kept and not out[5002].base_failed and out[5002].host_rate < 0.5 < 2 / 3
    differ = {r.source for r in out.values() if r.kept == r.base_failed}
    assert differ == {"large"} and not any(r.kept for r in out.values() if r.source == "large")


def test_host_rules_names_long_texts_and_equal_hosts(spark):
    schema = "doc_id long, text string, source string, __h int, __w int, __host int, __words int, n int, failed int"
    long = " ".join(f"w{i % 50_000}" for i in range(150_000))
    rows = [(1, long, "a", 1, 2, 3, 4, 5, 6), (1, long, "a", 1, 2, 3, 4, 5, 6), (2, "x", "b", 1, 2, 3, 4, 5, 6), (3, " ".join(f"v{i}" for i in range(25)), "b", 1, 2, 3, 4, 5, 6)]
    got = host_rules.apply_host_rules(spark, spark.createDataFrame(rows, schema)).collect()
    assert all((r["__h"], r["__w"], r["__host"], r["__words"], r.n, r.failed) == (1, 2, 3, 4, 5, 6) for r in got)
    assert sorted((r.doc_id, r.n_words, r.n_repeat_words, r.base_failed) for r in got) == [(1, 150_000, 150_000, True)] * 2 + [(2, 1, 0, True), (3, 25, 0, False)]
    assert {r.source: r.host_rate for r in got}["b"] <= 0.75
