"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its runs of five lower-cased words, weighted by
how often they occur.  Every unit of weight of an element is a region into which
hashed darts fall (Poisson, the same darts wherever the element has that much
weight).  A dart has a rank and a coordinate; the earliest dart of each
coordinate is the signature, so two documents agree in a coordinate with the
probability of their weighted Jaccard similarity.  Only regions of rank up to
about (ln k + 4) k / weight need be opened: long documents cost their length,
short ones k ln k darts; coordinates left empty open further regions.

Signatures are cut into ``BANDS`` bands of ``ROWS`` coordinates (a pair of
similarity 0.8 shares none with probability 3e-6).  Work is on distinct texts
(word sequences); copies only join their text's class.

1. A text has a leader in each band bucket: the text there that meets most others
   in all of its buckets (of edited copies the one they come from, as copies are less
   like each other).  It is compared with the first of its leaders first, with the
   others only where they are of another class by then: a link inside a class
   changes nothing.
2. Texts of buckets that hold several classes are then compared across classes
   where they share an element of their rare prefixes, which all pairs of the
   similarity do; so no link between different texts is lost, and neither pairs
   inside a class nor pairs with only a frequent passage in common are formed.
   The smallest id of each element goes first, for classes that it joins.
3. Pairs are verified on the whole element sets, an element standing for itself by
   64 bits of hash (weighted Jaccard >= 0.8).

Results: the class of a document is the smallest doc_id in its connected group.

Defined cases: a document of one to four words is one run of all its words; a
null, empty or blank text is alone in its class; ids are taken as unique, rows
that share one count as one document; rows without id get the class of their
text (null if no row with an id has it); empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, staged
from .graph import components
from .textbuf import SpanHasher, buffers, chunks, mix, ranges, shingles, split_words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 42, 6
_WORD, _TEXT = SpanHasher(31), SpanHasher(32)
_U = np.uint64
_LAYER, _CELL, _DART = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_FRACTION = 44
_NO_DART = _U(2**64 - 1)


def _poisson_steps() -> np.ndarray:
    """Upper ends, in 32-bit units, of the counts 0, 1, 2, ... of Poisson(1)."""
    term = total = float(np.exp(-1.0))
    out = [total]
    for i in range(1, 12):
        term /= i
        total += term
        out.append(total)
    return (np.array(out) * 2**32).astype(np.uint64)


_STEPS = _poisson_steps()


def elements(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(keys, first, id1, id2): unit-weight elements of each document (a run of
    words and its how-many-th occurrence), and two hashes of its word sequence."""
    n = len(offsets) - 1
    starts, ends, first = split_words(data, offsets)
    words = _WORD.words(data, starts, ends)
    count = np.diff(first)
    id1 = _WORD.spans(words, first[:-1], first[1:])
    id2 = _TEXT.spans(words, first[:-1], first[1:])
    runs = shingles(words, size)
    n_runs = np.maximum(count - size + 1, 0)
    keys = runs[ranges(first[:-1], n_runs)] if len(runs) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), n_runs)
    short = np.flatnonzero((count > 0) & (count < size))
    keys = np.concatenate([keys, mix(id1[short] + _LAYER)])
    owner = np.concatenate([owner, short])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(keys))
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0)) if len(keys) else at
    keys = mix(keys + occurrence.astype(np.uint64) * _LAYER)
    return keys, np.searchsorted(owner, np.arange(n + 1)), id1, id2


def dart_signatures(keys: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """(documents, k) earliest darts; a document without elements has none."""
    n = len(first) - 1
    weight = np.diff(first)
    out = np.full(n * k, _NO_DART)
    low = np.zeros(n, np.int64)
    high = np.ceil(k * (np.log(k) + 4.0) / np.maximum(weight, 1)).astype(np.int64)
    todo = np.flatnonzero(weight > 0)
    while len(todo):
        # a piece of documents at a time bounds the darts held at once
        cost = np.cumsum(weight[todo] * (high[todo] - low[todo]))
        for part in np.split(todo, np.unique(np.searchsorted(cost, np.arange(1_000_000, cost[-1], 1_000_000)))):
            if not len(part):
                continue
            item = ranges(first[part], weight[part])
            doc = np.repeat(part, weight[part])
            cells = high[doc] - low[doc]
            cell = ranges(low[doc], cells)
            doc = np.repeat(doc, cells)
            region = mix(np.repeat(keys[item], cells) ^ (cell.astype(np.uint64) * _CELL))
            darts = np.searchsorted(_STEPS, region >> _U(32), side="right")
            which = ranges(np.zeros(len(darts), np.int64), darts)
            dart = mix(np.repeat(region, darts) + (which.astype(np.uint64) + _U(1)) * _DART)
            rank = (np.repeat(cell, darts).astype(np.uint64) << _U(_FRACTION)) | (dart >> _U(64 - _FRACTION))
            coordinate = (dart & _U(0xFFFFF)) % _U(k)
            np.minimum.at(out, np.repeat(doc, darts) * k + coordinate.astype(np.int64), rank)
        missing = (out.reshape(n, k)[todo] == _NO_DART).any(axis=1)
        todo = todo[missing]
        low[todo], high[todo] = high[todo], 2 * high[todo]
    return out.reshape(n, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) bucket keys; the band's number is part of the key."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        key = mix(key * _LAYER + parts[:, :, r])
    return key


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, t1, t2, bands): word-sequence hashes and bucket keys; all null
    or empty for a document without words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))

    def work(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                e, first, id1, id2 = elements(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                has = np.diff(first) > 0
                keys = band_keys(dart_signatures(e, first, bands * rows), bands, rows).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
                # a batch of its own for each chunk bounds what both sides of the pipe hold
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(id1.view(np.int64), mask=~has),
                     pa.array(id2.view(np.int64), mask=~has),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[has].ravel(), pa.int64()))],
                    names=["doc_id", "t1", "t2", "bands"])
        pa.default_memory_pool().release_unused()

    return in_batches(texts, work, "doc_id long, t1 long, t2 long, bands array<long>")


def element_sets(docs: DataFrame) -> DataFrame:
    """(id, elements array<long>): the distinct 64-bit element keys of a document."""

    def work(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi in chunks(offsets):
                e, first, _, _ = elements(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)), pa.array(e.view(np.int64)))], names=["id", "elements"])
        pa.default_memory_pool().release_unused()

    return in_batches(docs.select("id", "text"), work, "id long, elements array<long>")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches ``threshold``.
    Merge joins: one plan at every size, and a much-paired id can be split."""
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"))
    shared = F.size(F.array_intersect("ea", "eb"))
    union = F.size("ea") + F.size("eb") - shared
    return (pairs.hint("merge").join(right, "b").hint("merge").join(left, "a")
            .where(shared >= threshold * union).select("a", "b"))


def _class_of(members: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    named = classes.select(F.col("node").alias(id_col), F.col("root").alias("_root"))
    return members.join(named, id_col, "left").withColumn("class", F.coalesce("_root", id_col)).drop("_root")


def _between(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of different classes, with these as (ca, cb)."""
    first = _class_of(pairs.select("a", "b"), classes, "a").withColumnRenamed("class", "ca")
    return _class_of(first, classes, "b").withColumnRenamed("class", "cb").where("ca != cb")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` when ``links`` (a, b) join some of them: components of the classes,
    a link for two classes, however many texts they hold."""
    joined = components(_between(links, classes).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    up = joined.select(F.col("node").alias("root"), F.col("root").alias("_up"))
    old = classes.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"))
    return staged(old.unionByName(joined.join(classes.select("node"), "node", "left_anti")), "classes")


def _prefixes(buckets: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(id, class, weight, element, rest): the rare elements of the texts whose
    buckets hold several classes, each with the weight from it on.

    Two texts of similarity ``threshold`` share one of the rarest (1 - threshold) * weight + 1 elements
    of each (prefix filter, exact for any order of the elements).  Texts that
    only share a frequent passage do not, since that is the last in the order."""
    members = _class_of(buckets.select("key", "id"), classes, "id")
    mixed = (members.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
             .where("lo != hi").select("key"))
    ids = members.hint("merge").join(mixed, "key").select("id", "class").distinct()
    texts = staged(ids.hint("merge").join(sets, "id").select("id", "class", "elements"), "mixed")
    each = texts.select("id", F.explode("elements").alias("element"))
    df = each.groupBy("element").agg(F.count(F.lit(1)).alias("df"))
    # an element of one text finds no partner; left out, it still counts in the weight
    ranked = (each.hint("merge").join(df.where("df > 1"), "element").groupBy("id")
              .agg(F.array_sort(F.collect_list(F.struct("df", "element"))).alias("order")))
    weight = F.size("elements")
    single = weight - F.size("order")
    length = weight - F.ceil(F.lit(threshold) * weight - 1e-9).cast("int") + 1
    # position in the order: the elements of this text alone come first
    rare = F.transform(F.slice("order.element", F.lit(1), F.greatest(length - single, F.lit(0))),
                       lambda e, i: F.struct(e.alias("element"), (weight - single - i).alias("rest")))
    return staged(texts.hint("merge").join(ranked, "id").select(
        "id", "class", weight.alias("weight"), F.explode(rare).alias("e")).select("id", "class", "weight", "e.*"), "prefix")


def _across(prefix: DataFrame, threshold: float, firsts: bool = False) -> DataFrame:
    """Pairs (a, b) of different classes to be compared: every pair of similarity
    ``threshold`` shares an element of ``prefix``, and sizes must allow the
    similarity.  With ``firsts`` only those with the smallest id of an element."""
    left = prefix
    if firsts:
        left = prefix.groupBy("element").agg(F.min(F.struct("id", "class", "weight", "rest")).alias("e")).select("element", "e.*")
    left = left.select("element", F.col("id").alias("a"), F.col("class").alias("ca"), F.col("weight").alias("wa"),
                       F.col("rest").alias("ra"))
    right = prefix.select("element", F.col("id").alias("b"), F.col("class").alias("cb"), F.col("weight").alias("wb"),
                          F.col("rest").alias("rb"))
    # from the first shared element on, both must hold enough elements for the overlap
    least = F.lit(threshold / (1 + threshold)) * (F.col("wa") + F.col("wb")) - 1e-9
    fits = (F.least("ra", "rb") >= least) & (F.col("ca") != F.col("cb") if firsts else F.col("ca") < F.col("cb"))
    both = left.hint("merge").join(right, "element").where(fits)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    repeated: bool = False) -> DataFrame:
    """(doc_id, class_id) of every document.  ``repeated``: rows may share id and
    text; the elements of such rows are then kept once."""
    marked = staged(sketches(docs, bands, rows), "sketches")
    texts = staged(marked.where("t1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("t1", "t2").agg(
        F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "texts")
    members = texts.select("id", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = staged(members.hint("merge").join(sizes, "key"), "buckets")
    ranked = buckets.groupBy("id").agg((-F.sum("n")).alias("order"))
    ordered = staged(buckets.select("key", "id").hint("merge").join(ranked, "id").select("key", F.struct("order", "id").alias("t")), "ordered")
    leaders = ordered.groupBy("key").agg(F.min("t").alias("leader"))
    led = staged(ordered.hint("merge").join(leaders, "key").where("t != leader").select(F.col("t.id").alias("id"), "leader").distinct(), "led")
    either = [F.least("id", "leader.id").alias("a"), F.greatest("id", "leader.id").alias("b")]
    pairs = led.select(*either)
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    with_text = docs.select(F.col("doc_id").cast("long").alias("id"), F.lower("text").alias("text")).hint("merge").join(wanted, "id")
    sets = element_sets(with_text)
    sets = staged(sets.dropDuplicates(["id"]) if repeated else sets, "sets")
    nearest = staged(led.groupBy("id").agg(F.min("leader").alias("leader")).select(*either), "nearest")
    classes = components(staged(verified(nearest, sets, threshold), "links"))
    others = staged(_between(pairs, classes).select("a", "b").join(nearest, ["a", "b"], "left_anti"), "others")
    if not others.isEmpty():
        classes = _merged(classes, staged(verified(others, sets, threshold), "links"))
    prefix = _prefixes(buckets, classes, sets, threshold)
    # a class that is found by its elements' first texts needs no pairs with the others
    firsts = staged(_across(prefix, threshold, firsts=True).join(pairs, ["a", "b"], "left_anti"), "firsts")
    if not firsts.isEmpty():
        classes = _merged(classes, staged(verified(firsts, sets, threshold), "links"))
        prefix = staged(_class_of(prefix.withColumnRenamed("class", "was"), classes, "was"), "prefix")
    tried = pairs.unionByName(firsts)
    more = staged(_across(prefix, threshold).join(tried, ["a", "b"], "left_anti"), "across")
    if not more.isEmpty():
        classes = _merged(classes, staged(verified(more, sets, threshold), "links"))
    text_class = _class_of(texts.select("t1", "t2", "id"), classes, "id").select("t1", "t2", "class")
    out = marked.select("doc_id", "t1", "t2").hint("merge").join(text_class, ["t1", "t2"], "left")
    return out.select("doc_id", F.coalesce("class", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of texts: that of smallest id (none
    comes last; then by the text's hash).  Rows are told apart by id and text, so
    texts that share an id are judged by themselves; rows of equal id and text are
    one document.  All rows without words stay."""
    one, two = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit("second"), F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), "text",
                       one.alias("h1"), two.alias("h2"), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("words"))
    texts = rows.where("words")
    classes = near_duplicates(texts.select(F.col("h1").alias("doc_id"), "text"), repeated=True, **options).select(
        F.col("doc_id").alias("h1"), "class_id").distinct()
    first = F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")
    kept = texts.select("id", "h1", "h2").join(classes, "h1").groupBy("class_id").agg(F.min(first).alias("k")).select("k.*")
    # different rows of one 64-bit hash cannot be told apart by it: all of them stay
    equal = texts.select("h1", "h2").distinct().groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1")
    kept = staged(kept.select("id", "h1", "h2").union(texts.join(equal, "h1", "left_semi").select("id", "h1", "h2")).distinct(), "kept")
    k = kept.select(F.col("id").alias("kid"), F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    left = texts.join(k, F.col("id").eqNullSafe(F.col("kid")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left_semi")
    left = left.dropDuplicates(["id", "h1", "h2"]).select("row.*")
    return left.unionByName(rows.where("NOT words").select("row.*"))
