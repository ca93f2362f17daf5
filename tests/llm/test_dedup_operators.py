"""Substring dedup, near-duplicates, nearest neighbours against brute force."""

import collections
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from helpers import near_classes, odd_documents, odd_frame, without_repeats, words  # noqa: E402

from rankspan.llm import ann, neardup, substring  # noqa: E402
from rankspan.llm.graph import components  # noqa: E402


def passages_corpus():
    r = random.Random(9)
    shared = [words(60, 500 + i) for i in range(4)]
    docs = []
    for d in range(80):
        text = words(r.choice([10, 34, 35, 36, 200]), 2000 + d)
        if d % 2:
            text += " " + r.choice(shared) + "\t" + words(r.randint(0, 50), 3000 + d)
        if d % 11 == 0:
            text = ("la " * r.randint(30, 90)).strip()
        docs.append(text)
    return docs + [docs[3], docs[3], docs[5].replace(" ", "  \n"), ("a b c " * 60), "", None, words(20_000, 7, 200)]


@pytest.mark.parametrize("hot", [substring.HOT, 1])
def test_substring_dedup(spark, hot):
    """Also with every repeated minimiser treated as a hot one."""
    docs = passages_corpus()
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted(tuple(r) for r in substring.deduplicate(frame, digests=True, hot=hot).collect())
    assert got == [(i, *w) for i, w in enumerate(without_repeats(docs))]


def test_substring_odd_tables(spark):
    docs = odd_documents()
    want = collections.Counter((d[0], *w) for d, w in zip(docs, without_repeats([d[1] for d in docs])))
    assert collections.Counter(tuple(r) for r in substring.deduplicate(odd_frame(spark), digests=True).collect()) == want
    assert substring.deduplicate(odd_frame(spark).limit(0)).count() == 0


def near_corpus():
    """Chains of edited copies, and crowds that only share a long passage."""
    r = random.Random(4)
    docs, passage = [], words(100, 77).split()
    for g in range(12):
        text = words(r.choice([6, 40, 150]), 900 + g).split()
        for _ in range(r.randint(1, 6)):
            docs.append(" ".join(text))
            text = list(text)
            for _ in range(r.randint(0, max(1, len(text) // 60))):
                text[r.randrange(len(text))] = f"e{r.randrange(10**6)}"
    docs += [" ".join(words(12, 4000 + i).split() + passage + words(12, 5000 + i).split()) for i in range(40)]
    docs += ["same line here now ok " * 20, "same line here now ok " * 21, "tiny text", "tiny text", "TINY  text"]
    r.shuffle(docs)
    return docs


def test_near_duplicates_equal_brute_force(spark):
    docs = list(enumerate(near_corpus()))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == near_classes(docs)


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """Texts of one class are linked to it about once each, not in every band."""
    r, base, docs = random.Random(8), words(300, 88).split(), []
    for i in range(150):
        text = list(base)
        for _ in range(3):
            text[r.randrange(300)] = f"e{r.randrange(10**6)}"
        docs.append((i, " ".join(text)))
    seen, linked = [], []
    verify, join = neardup.verified, neardup.components
    monkeypatch.setattr(neardup, "verified", lambda pairs, *a: seen.append(pairs.count()) or verify(pairs, *a))
    monkeypatch.setattr(neardup, "components", lambda links: linked.append(links.count()) or join(links))
    got = {x["doc_id"]: x["class_id"] for x in neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == near_classes(docs)
    assert sum(seen) < 2 * len(docs) and sum(linked) < 2 * len(docs)


def test_near_duplicates_odd_tables(spark):
    rows = neardup.near_duplicates(odd_frame(spark)).collect()
    assert len(rows) == len(odd_documents())
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert got[1] == got[2] == got[3] == 1 and got[8] == 8
    assert (got[4], got[5], got[6], got[7], got[None]) == (4, 5, 6, 7, None)
    assert neardup.near_duplicates(odd_frame(spark).limit(0)).count() == 0
    kept = neardup.keep_one(odd_frame(spark))
    assert kept.columns == odd_frame(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11]


def test_dart_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    shared, a, b = (r.integers(1, 2**62, n).astype(np.uint64) for n in (600, 200, 200))
    keys = np.concatenate([shared, a, shared, b])
    sig = neardup.dart_signatures(keys, np.array([0, 800, 1600, 1600]), 1000)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.06
    assert (sig[2] == np.uint64(2**64 - 1)).all()


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}


def vectors_frame(spark, x, ids=None):
    rows = [(int(i), None if v is None else [None if c is None else float(c) for c in v], 1)
            for i, v in zip(ids if ids is not None else range(len(x)), x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_nearest_recall_and_scores(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 32)) * r.uniform(0.5, 2.0, size=(3000, 1))
    frame = vectors_frame(spark, x)
    got = ann.nearest(frame, frame.where("vec_id % 20 = 0"), block=256).toPandas()
    s = x @ x.T
    hits = 0
    for q, rows in got.groupby("query_id"):
        score = s[q].copy()
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:20]
        rows = rows.sort_values("rank")
        assert list(rows["rank"]) == list(range(1, 21))
        assert np.allclose(rows["score"], score[rows["vec_id"]]) and (np.diff(rows["score"]) <= 0).all()
        hits += len(set(best) & set(rows["vec_id"]))
    assert got["query_id"].nunique() == 150 and hits / 3000 >= 0.9


def test_nearest_odd_vectors(spark):
    x = [[1.0, 0.0]] * 30 + [None, [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0], [1.0, 2.0, 3.0], [0.5, 0.5]]
    got = ann.nearest(vectors_frame(spark, x), vectors_frame(spark, x).where("vec_id % 20 = 0"), block=8).toPandas()
    assert set(got["query_id"]) == {0, 20}
    assert list(got[got["query_id"] == 0].sort_values("rank")["vec_id"]) == list(range(1, 21))
    assert list(got[got["query_id"] == 20].sort_values("rank")["vec_id"]) == list(range(20))
    few = vectors_frame(spark, x[:1] + x[-1:], [0, 1])
    assert [tuple(r) for r in ann.nearest(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.5)]
    assert ann.nearest(few.limit(0), few).count() == 0 and ann.nearest(few, few.limit(0)).count() == 0
    assert abs(ann.chi2_cdf(18.307, 10) - 0.95) < 1e-4 and abs(ann.chi2_quantile(0.95, 10) - 18.307) < 1e-3
