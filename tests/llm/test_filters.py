"""URL filters, the quality classifier and metric search against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import metric_search, quality, url_filter

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]

URLS = [
    None,
    "",
    "no scheme/en/",
    "http://",
    "HTTP://WWW.Example.COM/en/x?y#z",
    "http://a.www.example.com/en/",
    "http://b.example.com/en/1",
    "http://b.example.com/en",
    "http://notexample.com/en/1",
    "https://x.net/es/é",
    "https://x.net?q=/es/",
    "https://net/es/",
    "https://com",
    "x://y://z.com/a",
    "http://Ünï.com/\nnew#",
    "http://b.example.com/en/1",
]


def judged(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for says, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = (says, rule)
    return host, path, best[1] if best else None, best[0] if best else "allow"


def test_urls_by_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for r in url_filter.judge_urls(pages, RULES).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(r.url)
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.01, 0.5, 0.97, 1.0])
def test_cascade_is_exact_on_its_universe(share):
    rng = np.random.default_rng(11)
    h1, h2 = (rng.integers(0, 2**63, 20_000).astype(np.uint64) for _ in range(2))
    listed = rng.random(20_000) < share
    cascade = url_filter.cascade_of(h1, h2, listed)
    assert (url_filter.listed_by(cascade, h1, h2) == listed).all()
    assert not url_filter.listed_by(None, h1, h2).any()
    if share == 0.01:
        assert len(cascade) < 20_000 / 8  # less than a bit a key


@pytest.mark.parametrize("most", [url_filter.BROADCAST_BYTES, 0])
def test_membership_with_and_without_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", most)
    monkeypatch.setattr(url_filter, "SEGMENT_KEYS", 300)
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade, segments = url_filter.build_cascade(keys.union(keys.limit(500)))
    assert segments > 5
    rows = url_filter.with_membership(keys.withColumnRenamed("listed", "wanted"), F.col("key"), cascade, segments)
    assert rows.count() == 2000 and rows.where("listed <> wanted").count() == 0


def word(draw):
    return "".join(draw.choices("abcdefgh", k=draw.randint(2, 7)))


def test_classifier_learns_and_repeats(spark):
    draw = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        good = i % 4 != 0
        words = [word(draw) + ("" if good else "!!") for _ in range(draw.randint(5, 60))]
        rows.append((i, " ".join(words), 1 - int(good)))
        labels.append((i, int(good), 0))
    rows += [(1000, None, 0), (1001, "", 0), (None, "abc abc", 0), (5, "again", 0)]
    labels += [(1, None, 0), (2, 7, 0), (None, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality.scored_documents(docs, known).collect()
    assert len(scored) == len(rows)
    out = [r for r in scored if r.held_out and r.doc_id < 600]
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    again = {(r.doc_id, r.score) for r in quality.scored_documents(docs.repartition(5), known.repartition(2)).collect()}
    assert again == {(r.doc_id, r.score) for r in scored}
    assert {r.score for r in quality.scored_documents(docs, known.limit(0)).collect()} == {0.5}
    assert quality.scored_documents(docs.limit(0), known).count() == 0


def test_features_are_indicators():
    flags = np.zeros(quality.FEATURES, bool)
    one = quality.features(np.frombuffer(b"abcabc", np.uint8), flags)
    many = quality.features(np.frombuffer(b"abc" * 50, np.uint8), flags)
    assert one.tolist() == many.tolist() and not flags.any()
    assert [len(quality.features(np.frombuffer(t, np.uint8), flags)) for t in (b"", b"a", b"ab", b"abc")] == [0, 0, 1, 3]


def brute(rows, k):
    usable = {i: [int(np.floor(np.float64(x) * 64)) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q, v in usable.items():
        if q % 3 == 0:
            others = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable.items() if i != q and len(w) == len(v)]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(others)[:k])}
    return out


@pytest.mark.parametrize("sizes", [(8192, 256), (40, 8)])
def test_top_k_is_exact(spark, monkeypatch, sizes):
    monkeypatch.setattr(metric_search, "SUBTREE_ROWS", sizes[0])
    monkeypatch.setattr(metric_search, "PAGE_ROWS", sizes[1])
    monkeypatch.setattr(metric_search, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(200)]
    rows += [(300 + i, [0.5] * 6) for i in range(120)]  # one common vector
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, [1.0, 2.0]), (507, [3.0, 4.0]), (510, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    found = metric_search.top_k(df, F.col("vec_id") % 3 == 0, k=5)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert {tuple(r) for r in found.collect()} == brute(exact, 5)
    assert metric_search.top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0


def test_the_second_hash_is_no_function_of_the_first(spark):
    """xxhash64 of several columns takes the hash so far as the seed: a literal after the key adds nothing to the first hash."""
    rows = url_filter.hashed(spark.range(50).select(F.col("id").cast("string").alias("key")), F.col("key"), 1)
    derived = rows.select("h2", F.expr("xxhash64(key, 'second')").alias("after")).collect()
    assert all(r.h2 != r.after for r in derived) and len({r.h2 for r in derived}) == 50
