"""Small tables and brute-force versions shared by the tests."""

import collections
import hashlib
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, size=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


def odd_documents():
    """Nulls in every column, empty and blank texts, copies, a repeated row."""
    base = words(120, 1)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "a", 9), (2, base, "en", "a", 9), (3, " ".join(near), None, None, None),
        (4, None, "en", "a", None), (5, "", "en", "a", 0), (6, " \t\n ", "en", "a", 4), (7, "one two", "fr", "b", 7),
        (8, words(300, 2), "en", "b", 1), (8, words(300, 2), "en", "b", 1), (None, words(50, 3), "en", "b", 1),
        (9, words(30_000, 4, 10**6), "en", "long", 1), (10, "x" * 200_000, "en", "long", 1), (11, "ÄÖ é 漢字 \U0001F600 ß", "de", "c", 9)]


def odd_frame(spark):
    """The odd documents with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_documents(), DOCS)
    for name in ("score", "ids", "key", "id", "class", "_t", "_base", "rank", "bands", "version", "places", "weight"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_repeats(docs, size=35):
    count = collections.Counter(tuple(w[i:i + size]) for w in map(split, docs) for i in range(len(w) - size + 1))
    out = []
    for w in map(split, docs):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingle_counts(text):
    w = (text or "").lower().split()
    if 0 < len(w) < 5:
        return collections.Counter([tuple(w)])
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_classes(docs, threshold=0.8):
    """doc_id -> smallest id of its connected group, all pairs compared."""
    sets = {i: shingle_counts(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = sum((sets[a] & sets[b]).values())
            union = sum((sets[a] | sets[b]).values())
            if union and shared >= threshold * union:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
