"""Periodic runs, source divergence and the URL filter against brute force."""

import collections
import hashlib
import os
import random
import re
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from helpers import odd_documents, odd_frame, split, words  # noqa: E402

from rankspan.llm import divergence, periodic, urls  # noqa: E402
from rankspan.llm.bloom import BlockedBloom, block_count  # noqa: E402
from rankspan.llm.queries import URL_RULES  # noqa: E402


# ------------------------------------------------------------------ runs
def brute_runs(w):
    found, n = {}, len(w)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((s, length, p) for (s, length), p in found.items())


def brute_row(doc_id, text, rewrite):
    w = split(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = [False] * n
    for s, length, p in runs:
        gone[s + p:s + length] = [True] * (length - p)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(x for x, y in zip(w, gone) if not y)))


def looping_texts():
    r = random.Random(5)
    out = []
    for d in range(150):
        size = r.choice([1, 2, 3, 40])
        text = [f"w{r.randrange(size)}" for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            unit = [f"w{r.randrange(4)}" for _ in range(r.randint(1, 12))]
            text += unit * r.randint(2, 9) + unit[:r.randrange(len(unit))] + [f"w{r.randrange(size)}" for _ in range(r.randint(0, 9))]
        out.append((d, r.choice([" ", "\t", "  \n"]).join(text)))
    return out


@pytest.mark.parametrize("rewrite", [False, True])
def test_runs_equal_brute_force(spark, rewrite):
    docs = looping_texts() + [(1000 + i, words(200 + i, i, 30)) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in periodic.collapse_runs(frame, digests=True, rewrite=rewrite).collect())
    assert got == sorted(brute_row(i, t, rewrite) for i, t in docs)


def test_runs_full_rows(spark):
    frame = spark.createDataFrame([(1, "x " + "a b " * 5 + "a y"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in periodic.collapse_runs(frame).collect()}
    assert [tuple(x) for x in rows[1]["runs"]] == [(1, 11, 2)] and rows[1]["collapsed"] == "x a b y"
    assert rows[2]["runs"] == [] and rows[2]["collapsed"] == ""


def test_runs_odd_tables(spark):
    docs = [d[:2] for d in odd_documents() if not d[1] or len(d[1]) < 20_000]
    want = collections.Counter(brute_row(i, t, True) for i, t in docs)
    frame = odd_frame(spark).where("source IS NULL OR source != 'long'")
    assert collections.Counter(tuple(r) for r in periodic.collapse_runs(frame, digests=True, rewrite=True).collect()) == want
    assert periodic.collapse_runs(odd_frame(spark).limit(0)).count() == 0


def test_long_texts_of_one_word_and_of_a_long_period():
    n = 300_000
    d, s, length, p = periodic.find_runs(np.zeros(n, np.int64), np.array([0, n]))
    assert [(int(a), int(b), int(c)) for a, b, c in zip(s, length, p)] == [(0, n, 1)]
    unit = np.random.default_rng(1).integers(0, 10**9, 30_011)
    w = np.unique(np.concatenate([[-1], np.tile(unit, 6)[:150_000], [-2]]), return_inverse=True)[1]
    d, s, length, p = periodic.find_runs(w, np.array([0, len(w)]))
    assert [(int(a), int(b), int(c)) for a, b, c in zip(s, length, p)] == [(1, 150_000, 30_011)]


def test_grammar_queries_equal_direct_comparison():
    r = np.random.default_rng(2)
    for size in (1, 2, 5):
        w = np.concatenate([[90], r.integers(0, size, 400), [91], r.integers(0, size, 300), [92]])
        grammar = periodic.Grammar(w, w >= 90)
        i, j = np.sort(r.integers(1, 401, (2, 3000)), axis=0)
        i, j = i[i != j], j[i != j]
        for forward in (True, False):
            step = 1 if forward else -1
            want = []
            for a, b in zip(i.tolist(), j.tolist()):
                k = 0
                while w[a + step * k] == w[b + step * k]:
                    k += 1
                want.append(k)
            assert grammar.extend(i, j, forward).tolist() == want


# ------------------------------------------------------------------ terms
def brute_audit(docs, least=3, top=200):
    docs = [(lang or "", source or "", [t.translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
                                         for t in re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text or "")]) for lang, source, text in docs]
    out = []
    for lang in {x[0] for x in docs}:
        df = collections.Counter(t for a, _, ts in docs if a == lang for t in set(ts))
        kept = {t for t, n in df.items() if n >= least}
        counts = collections.defaultdict(collections.Counter)
        for a, source, ts in docs:
            if a == lang:
                counts[source].update(t for t in ts if t in kept)
        whole = sum(counts.values(), collections.Counter())

        def value(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: value(c) for s, c in counts.items()}, value(whole)
        for s in counts:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != s]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:limit])]
    return sorted(out)


def term_documents():
    r = random.Random(8)
    common = [f"{chr(97 + i % 26)}{'xyz'[i % 3]}{'word' * (i % 5)}{chr(233 + i % 9)}" for i in range(60)]
    rare = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 20))) for _ in range(400)]
    docs = []
    for d in range(120):
        text = r.choices(common, k=r.randint(0, 40)) + r.choices(rare, k=r.randint(0, 6))
        docs.append((r.choice(["en", "de", None]), r.choice(["a", "b", "c", None]), r.choice([" ", "; ", "1"]).join(text).title() or None))
    return docs + [("xx", "lone", "one two"), ("yy", "p", "some words"), ("yy", "q", None), ("", "a", "Äpfel äpfel ÄPFEL")]


@pytest.mark.parametrize("levels, most_bytes", [((3, 6, 12), 1 << 20), ((1, 2, 4, 8, 16), 32), ((), 1)])
def test_audit_equals_brute_force(spark, levels, most_bytes):
    """Also with a filter so small that it lets everything pass, and without levels."""
    docs = term_documents()
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(7)
    got = sorted(tuple(r) for r in divergence.audit(frame, levels=levels, most_bytes=most_bytes).collect())
    assert got == brute_audit(docs)


def test_audit_odd_tables(spark):
    docs = [(d[2], d[3], d[1]) for d in odd_documents()]
    got = sorted(tuple(r) for r in divergence.audit(odd_frame(spark), top=3).collect())
    assert got == brute_audit(docs, top=3)
    assert divergence.audit(odd_frame(spark).limit(0)).count() == 0


def test_prefix_level_counts_documents(spark):
    frame = spark.createDataFrame([("en", "s", "abcd abce abcf"), ("en", "s", "abxx"), ("en", "s", "ab zz"), ("de", "s", "ab")],
                                  "lang string, source string, text string")
    rows = divergence.prefix_level(frame, 2, 0, None, 3).collect()
    assert [(r["lang"], bytes(r["prefix"]), r["docs"]) for r in rows] == [("en", b"ab", 3)]


# ------------------------------------------------------------------ urls
def brute_url(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = (url or "")[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, default)
    return host, path, rule, verdict


def odd_urls():
    r = random.Random(6)
    hosts = ["example.com", "WWW.Example.com", "a.b.example.com", "notexample.com", "x.net", "net", "com", "com.", ".com", "", "a..com", "é.com", "u:p@x.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/es/q", "/fr/", "/FR/", "/en/%2F", "/ä/b", "x"]
    tails = ["", "?a=1", "#top", "?q=://z.net/es/", "#/en/", "\n"]
    urls_ = [f"{r.choice(['http', 'https', 'ftp', ''])}://{r.choice(hosts)}{r.choice(paths)}{r.choice(tails)}" for _ in range(400)]
    return urls_ + [None, "", "no scheme", "mailto:a@b.com", "http:/one.com/", "://com/", "http://" + "a." * 300 + "com/" + "p/" * 5000, "http://x.com/" * 2000]


RULES = [*URL_RULES, ("example.com", "/e", "allow"), ("com", "/en/x", "block"), ("a.b.example.com", "", "block"), ("é.com", "/ä", "block"), ("com", "/fr/", "block")]


@pytest.mark.parametrize("rules, most_bytes", [(list(URL_RULES), 1 << 20), (RULES, 1 << 20), (RULES, 32), ([], 1 << 20)])
def test_url_rules_equal_brute_force(spark, rules, most_bytes):
    """Also with a filter of one block, which passes nearly everything."""
    found = odd_urls()
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(found)], "page_id long, url string").repartition(5)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(tuple(r) for r in urls.filter_urls(frame, table, most_bytes=most_bytes).collect())
    assert got == [(i, *brute_url(u, rules)) for i, u in enumerate(found)]


def test_listed_urls(spark):
    frame = spark.createDataFrame([(1, "http://A.org:80/x?b=2&utm_source=z&a=1#t"), (2, "https://a.org/x?a=1&b=2"), (3, "https://a.org/x"),
                                   (4, "https://b.com"), (5, None)], "page_id long, url string")
    listed = spark.createDataFrame([("ftp://a.org/x?a=1&b=2",), ("http://b.com/",), (None,)], "url string")
    rules = spark.createDataFrame([("com", "", "allow")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.filter_urls(frame, rules, listed).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: (None, "allow"), 4: ("com", "allow"), 5: (None, "allow")}


def test_url_odd_tables(spark):
    rows = [(1, "http://x.net/es/1"), (1, "http://x.net/es/1"), (None, "http://x.net/es/1"), (2, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("host", "path", "rule", "verdict", "hits", "id", "canonical", "i", "best", "html", "probes"):
        frame = frame.withColumn(name, F.lit("clash"))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = collections.Counter(tuple(r) for r in urls.filter_urls(frame, rules).collect())
    assert got == collections.Counter((i, *brute_url(u, URL_RULES)) for i, u in rows)
    assert urls.filter_urls(frame.limit(0), rules).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = np.random.default_rng(3).integers(-2**62, 2**62, 20_000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(4)
    built = BlockedBloom.build(frame)
    assert built.may_hold(keys).all()
    assert BlockedBloom.of(keys).may_hold(keys).all()
    others = np.random.default_rng(4).integers(-2**62, 2**62, 50_000)
    assert built.may_hold(others).mean() < 0.01
    assert block_count(10**12, 1 << 20) == 32768 and block_count(0) == 1
