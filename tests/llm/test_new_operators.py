"""Lexical search, URL rules and whitening against brute force, odd inputs included."""

import math
import re
from collections import Counter
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallgrass.llm import lexical_search, url_rules, whitening
from tests.llm.conftest import ODD

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# -- 11 lexical search ---------------------------------------------------------
def split_terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranking(docs, items, k=10):
    """(item_id, rank, doc_id, score) by the formula."""
    held = [(i, Counter(t)) for i, t in ((i, split_terms(t)) for i, t in docs) if t]
    big_n, big_l = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for i, c in held:
            m = 10 + 90 * c.total() * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(split_terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(docs, items, spark, make_docs, ids=None, **kw):
    df = spark.createDataFrame(items, "item_id long, text string")
    out = lexical_search.search(make_docs(docs, ids), df, **kw).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in out), key=str)


SEARCHED = [*ODD, "The CAT, the cat", "mat-cat é日本", "Ünder É the", "cat " * 7 + "dog", "10^9 cats 7"] + ["cat mat tie"] * 15


def test_ranking_matches_the_formula(spark, make_docs):
    items = [(1, "the cat sat"), (2, "É é tie dog"), (3, None), (4, ""), (5, "nothing here fits zzz"), (1, "the cat sat"),
             (1, "another text 日本"), (None, "7 cats"), (6, "mat " * 500 + "tie")]
    docs = list(enumerate(SEARCHED))
    want = ranking(docs, items)
    assert found(SEARCHED, items, spark, make_docs) == want
    # blocks and their bounds change nothing
    assert found(SEARCHED, items, spark, make_docs, block_items=2, block_terms=3) == want


def test_ties_are_decided_by_id(spark, make_docs):
    n = 700
    ids = [(i * 389) % n for i in range(n - 2)] + [None, 5]
    out = found(["one two three"] * n + ["else"] * 9, [(0, "two one")], spark, make_docs, ids + [None] * 9, k=12)
    assert [r[2] for r in sorted(out, key=lambda r: r[1])] == sorted(i for i in ids if i is not None)[:12]


def test_long_texts_are_split_in_segments(monkeypatch):
    monkeypatch.setattr(lexical_search, "SEGMENT", 5)
    for t in ODD + ["aa bb-cc DD éé", "x" * 40, ""]:
        parts = [w.decode() for p in lexical_search.terms((t or "").encode()) for w in p]
        assert parts == split_terms(t)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 5), st.integers(0, 2**31), st.sampled_from([1, 2, 4096]))
def test_tiles_add_up_exactly(n_items, n_docs, seed, width):
    rng = np.random.default_rng(seed)
    weights = rng.integers(0, 40_000, (n_items, 30)).astype(float)
    dense = rng.integers(0, 10**6, (30, n_docs)) * (rng.random((30, n_docs)) < 0.5)
    places, docs = np.nonzero(dense)
    was, lexical_search.STRIP_TERMS = lexical_search.STRIP_TERMS, width
    try:
        got = lexical_search.tile_scores(weights, places, docs, dense[places, docs], n_docs)
    finally:
        lexical_search.STRIP_TERMS = was
    assert (got == weights.astype(np.int64) @ dense).all()


def test_strips_stay_below_the_exact_range():
    w = np.full((1, 1), 2.0**40)
    assert lexical_search.strip_width(w) * 2**40 * 10**6 < 2**53 or lexical_search.strip_width(w) == 1
    assert lexical_search.strip_width(np.full((1, 1), 42_000.0)) == lexical_search.STRIP_TERMS


def test_search_of_empty_tables(spark, make_docs):
    assert found([], [(1, "a")], spark, make_docs) == []
    assert found(["a b"], [], spark, make_docs) == []


# -- 12 URL rules --------------------------------------------------------------
def parts(url):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def listed(host, path):
    fits = [r for r in url_rules.LISTED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def tokens_of(url):
    host, path = parts(url)
    names = host.split(".")
    out = {f"host:{w}" for n in names[:-1] for w in n.split("-") if w} | ({f"last:{names[-1]}"} if names[-1] else set())
    return out | {f"path:{w}" for w in re.findall(r"(?:[^\W\d_]|#)+", re.sub("[0-9]+", "#", path.translate(LOWER)))}


ODD_URLS = [None, "", "no scheme", "://", "http://", "http://ORG", "HTTP://Org/", "x://a.org/es", "x://example.org/es/1",
            "x://b.example.org/en/17", "x://example.org/en/2?://", "x://com/fr", "x://com/fr/", "x://a.b.com/de/#x", "x://aorg/",
            "x://org?q/", "x://org#/", "ftp://a-b.Net/Path-9/é.html", "y:///only/path", "http://a/b://c", "x://example.org/es/",
            "z://" + "a." * 3000 + "org/" + "p/" * 3000]


def pages_of(spark, urls):
    rows = [(i, u, "h", 1.0, "t") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, support double, tokens string")


def test_hosts_paths_and_listed_rules(spark):
    out = {r.page_id: r for r in url_rules.filter_urls(pages_of(spark, ODD_URLS)).collect()}
    assert len(out) == len(ODD_URLS)
    for i, u in enumerate(ODD_URLS):
        host, path = parts(u)
        rule = listed(host, path)
        assert (out[i].host, out[i].path) == (host, path), u
        assert out[i].rule == (rule.name if rule else None), u
        if rule:
            assert out[i].verdict == rule.verdict


def mined_rules(labelled, min_share, min_count, confidence):
    """All itemsets of the labelled sets, by counting every subset."""
    n, label = Counter(), Counter()
    for t, v in labelled:
        for size in range(1, len(t) + 1):
            for s in combinations(sorted(t), size):
                n[s] += 1
                label[s, v] += 1
    least = max(min_count, min_share * len(labelled))
    rules = {(s, v): c / n[s] for (s, v), c in label.items() if c >= least and c / n[s] >= confidence}
    return {k: c for k, c in rules.items()
            if not any(rules.get((k[0][:j] + k[0][j + 1:], k[1]), -1) >= c for j in range(len(k[0])) if len(k[0]) > 1)}


def test_mined_rules_match_counting(spark):
    rng = np.random.default_rng(3)
    urls = [f"http://{rng.choice(['a', 'b', 'c-d'])}.example.{rng.choice(['org', 'com', 'net'])}/"
            f"{rng.choice(['de', 'fr', 'es', 'en'])}/{rng.integers(1, 3000)}{rng.choice(['', '.html', '/'])}" for _ in range(600)]
    urls += urls[:50]
    labelled = {u: listed(*parts(u)) for u in urls}
    sets = [(tokens_of(u), r.verdict) for u, r in labelled.items() if r]
    want = mined_rules(sets, url_rules.MIN_SHARE, url_rules.MIN_COUNT, url_rules.MIN_CONFIDENCE)
    df = pages_of(spark, urls).select("url")
    h, p = url_rules.host_and_path(F.col("url"))
    df = df.withColumn("host", h).withColumn("path", p)
    df = df.withColumn("verdict", url_rules.listed_rule(F.col("host"), F.col("path"), url_rules.LISTED)[1]) \
        .withColumn("tokens", url_rules.url_tokens(F.col("host"), F.col("path"))).where("verdict is not null")
    got = {(tuple(r.tokens), r.verdict): r for r in url_rules.mine(df).collect()}
    assert got.keys() == want.keys() and len(want) >= 4
    for k, r in got.items():
        assert math.isclose(r.confidence, want[k]) and r.token in k[0]
    # verdicts: the strongest rule that fits
    support = Counter()
    for t, v in sets:
        for k in want:
            support[k] += set(k[0]) <= t and v == k[1]
    for r in url_rules.filter_urls(pages_of(spark, urls)).collect():
        if r.rule is None:
            fits = [(c, support[k], len(k[0]), k[1] == "block", " ".join(k[0]), k[1]) for k, c in want.items()
                    if set(k[0]) <= tokens_of(urls[r.page_id])]
            assert r.verdict == (max(fits)[-1] if fits else "allow")


def test_one_long_url_many_times_does_not_explode(spark):
    urls = [f"http://h.example.org/{'/'.join(f'w{chr(97 + j)}' for j in range(25))}/{i}" for i in range(60)]
    out = url_rules.filter_urls(pages_of(spark, urls + ["http://q.net/wa/wb"])).collect()
    assert {r.verdict for r in out} == {"allow"} and len(out) == 61


def test_no_labels_and_empty_pages(spark):
    assert [r.verdict for r in url_rules.filter_urls(pages_of(spark, ["http://a.net/", None])).collect()] == ["allow"] * 2
    assert url_rules.filter_urls(pages_of(spark, []).limit(0)).collect() == []


# -- 13 whitening ----------------------------------------------------------------
def matrix(seed, n, size, scale):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, size)) @ (rng.standard_normal((size, size)) * scale)


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0) for i, v in rows],
                                 "vec_id long, embedding array<float>, component int, n int")


def whole(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def test_whitening_matches_a_full_decomposition(spark):
    x = matrix(1, 300, 12, 0.2).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(0, [float(c) for c in x[0]]), (None, [float(c) for c in x[1]])]
    used = [whole(v) for _, v in rows]
    bad = [(900, None), (901, [None] + [0.0] * 11), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11), (904, []), (905, [1.0])]
    out = whitening.whiten(vectors_of(spark, rows + bad), components=5).collect()
    n = len(rows)
    w = np.array(used, object)
    s = w.sum(0)
    d = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(v, s)] for v in used])
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1][:5], u[:, ::-1][:, :5]
    assert len(out) == n * 5 and {r.n for r in out} == {n}
    got = {}
    for r in out:
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for (i, v), y, z in zip(rows, used, d @ u / np.sqrt(e)):
        deviation = sum((n * a - int(b)) ** 2 for a, b in zip(y, s))
        own = got[i, deviation]
        for k in range(1, 6):
            assert abs(abs(own[k].whitened) - abs(z[k - 1])) < 1e-9
            assert math.isclose(own[k].explained, e[k - 1] / np.trace(d.T @ d / n), rel_tol=1e-11)
            assert own[k].identity_error < 1e-10
    for k in range(1, 6):
        signs = {np.sign(got[i, sum((n * a - int(b)) ** 2 for a, b in zip(y, s))][k].whitened * z[k - 1])
                 for (i, _), y, z in zip(rows, used, d @ u / np.sqrt(e)) if abs(z[k - 1]) > 1e-6}
        assert len(signs) == 1


@pytest.mark.parametrize("a", [
    np.diag([3.0, 3, 3, 1, 1]), np.ones((6, 6)), np.diag([1.0]), np.diag([2.0, 5]), np.eye(7) * 1e12, np.eye(4) * 1e-200,
    matrix(2, 50, 50, 1) @ matrix(2, 50, 50, 1).T, np.kron(np.eye(4), np.array([[2.0, 1], [1, 2]])),
    # a Wilkinson matrix: pairs of nearly equal eigenvalues
    np.diag(np.abs(np.arange(21) - 10.0)) + np.eye(21, k=1) + np.eye(21, k=-1)])
def test_leading_eigenvectors(a):
    size = len(a)
    values, vectors = whitening.leading(a, 32)
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    norm = want[0]
    assert np.allclose(values, want[:len(values)], rtol=0, atol=size * 4e-15 * norm)
    assert len(values) == min(32, (want > 1e-12 * norm).sum())
    assert np.abs(a @ vectors - vectors * values).max() < size * 1e-14 * norm
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_no_variance_and_empty_table(spark):
    assert whitening.whiten(vectors_of(spark, [(1, [0.5, 1.0])] * 3)).collect() == []
    assert whitening.whiten(vectors_of(spark, [(1, [0.5, 1.0])]).limit(0)).collect() == []
    # two vectors: one direction
    out = whitening.whiten(vectors_of(spark, [(1, [0.5, 1.0]), (2, [9.0, -1.0])])).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in out) == [(1, 1, 1.0), (2, 1, 1.0)]
    assert all(math.isclose(r.explained, 1.0) for r in out)


def test_huge_entries_have_a_defined_result(spark):
    out = whitening.whiten(vectors_of(spark, [(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [0.0, -1.0])])).collect()
    first = [r for r in out if r.component == 1]
    assert [r.deviation for r in first] == [None] * 3 and len(first) == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-2**50, 2**50), min_size=3, max_size=3), min_size=1, max_size=5), st.integers(1, 2**20))
def test_deviations_are_exact_or_null(rows, n):
    base, rest = [5, -7, 2**33], [n // 2, 0, n - 1]
    model = whitening.Whitening(n, base, rest, np.zeros((3, 0)), np.zeros(0))
    want = [sum((n * (v - b) - r) ** 2 for v, b, r in zip(x, base, rest)) for x in rows]
    assert model.deviations(np.array(rows, np.int64)) == [w if w < 2**63 else None for w in want]
