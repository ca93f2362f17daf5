"""Source divergence audit by iceberg prefix refinement.

A term is kept in a language if at least ``least`` documents of it hold the term.
Kept terms are found by refining byte prefixes level by level: a prefix that fewer
than ``least`` documents hold cannot be the start of a kept term, so the next,
longer level only looks at terms whose prefix is left, and after the last level
whole terms are counted.

* One level is one pass over the texts.  A task finds the distinct prefixes of
  each document, counts documents per prefix in a chunk, and Spark adds the counts.
* The prefixes left reach the next pass as a Bloom filter of bounded size.  A false
  positive only lets a rare prefix through: whole terms are counted exactly at the
  end, and those of fewer than ``least`` documents go there.
* Whole terms arrive with their counts per source, pre-aggregated, and meet once
  per (language, term): a row with at most as many entries as there are sources.

Each (language, source) group is then compared, in integers, with every other
source of its language over all kept terms (part ``pair``) and term by term with
its language (part ``term``).  With f(p, q) = floor((p - q)^2 / q), and p0 the value
of a group for a term it does not hold, the sum over all kept terms of f(p_s, p_t) is

    V f(p0_s, p0_t) + sum over terms of s of  f(p_s, p0_t) - f(p0_s, p0_t)
                    + sum over terms of t of  f(p0_s, p_t) - f(p0_s, p0_t)
                    + sum over terms of both  of what the three miss,

so terms that neither source holds cost nothing; the two middle sums run over the
distinct values of a source, the last over the sources of each term.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.  Defined cases:
null text, lang and source count as ''; each row is a document, repeated rows too;
a group without terms has its pairs (and no terms); a language without kept terms
gives 0 for each pair; one with a single source has no pairs; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.common import top_k
from .bloom import MOST_BYTES, BlockedBloom, hash_bytes
from .common import in_batches, staged
from .textbuf import buffers, chunks, mix, ranges, split_words

LEAST_DOCUMENTS = 3
LEVELS = (3, 6, 12)           # bytes
TOP_TERMS = 200
SCALE = 1_000_000_000
CHUNK = 2 << 20
MOST_DOCUMENTS = 1 << 16      # of a chunk
PAIRS = 1 << 20               # pairs of sources held at once

# The separators of [^\x00-\x40\x5B-\x60\x7B-\x7F]+ .
NOT_TERM = np.zeros(256, dtype=bool)
NOT_TERM[:0x80] = True
NOT_TERM[0x41:0x5B] = False
NOT_TERM[0x61:0x7B] = False

# the n highest bytes of a 64-bit number
_HIGH = np.array([(2**64 - 1) ^ (2**(64 - 8 * n) - 1) for n in range(9)], dtype=np.uint64)


class Terms:
    """The terms of the documents of a chunk: distinct ones, and one row
    (document, term, count) for each that a document holds, by document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, first = split_words(data, offsets, NOT_TERM)
        size = ends - starts
        spans = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        text = data[~NOT_TERM[data]]                  # terms are all that is left
        column = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(spans), pa.py_buffer(text)])
        coded = column.dictionary_encode()
        self.terms = coded.dictionary
        width = max(1, len(self.terms))
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        key, self.count = np.unique(owner * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        self.doc, self.term = key // width, key % width

    def prefixes(self, size: int) -> tuple[pa.Array, np.ndarray]:
        """(distinct prefixes of ``size`` bytes, the prefix of each distinct term)."""
        return _codes(pc.binary_slice(self.terms, 0, size))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (sorting beats the hash table of ``np.unique`` here)."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def _codes(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    coded = column.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def short_prefixes(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Distinct (prefix of at most 6 bytes, document) of a chunk as sorted 64-bit
    numbers: the prefix's bytes in the high 48 bits, zero-filled, then the document."""
    starts, ends, first = split_words(data, offsets, NOT_TERM)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))[starts].astype(np.uint64)
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first))
    return _distinct(eight & _HIGH[np.minimum(ends - starts, size)] | owner)


def prefix_bytes(numbers: np.ndarray) -> pa.Array:
    """The prefixes as byte strings; no term holds a zero byte."""
    table = numbers.astype(">u8").view(np.uint8).reshape(-1, 8)
    ends = np.concatenate([[0], np.cumsum(np.count_nonzero(table, axis=1))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(numbers), [None, pa.py_buffer(ends), pa.py_buffer(table[table != 0])])


def _held(texts: pa.Array, lang: np.uint64, bloom: BlockedBloom | None) -> np.ndarray:
    """Which prefixes were left in the language."""
    return np.ones(len(texts), dtype=bool) if bloom is None else bloom.may_hold(mix(hash_bytes(texts) ^ mix(lang)))


def _segments(batch: pa.RecordBatch, keys: tuple[int, ...]):
    """(key values, lower-cased bytes, offsets) of the documents of one group of
    the batch at a time, in chunks of bounded size."""
    names, codes = zip(*(_codes(batch.column(k)) for k in keys), strict=True)
    order = np.lexsort(codes[::-1])
    data, offsets = buffers(batch.column(2).take(pa.array(order)))
    codes = [c[order] for c in codes]
    new = np.zeros(len(order), dtype=bool)
    for c in codes:
        new[1:] |= c[1:] != c[:-1]
    cuts = [0, *np.flatnonzero(new).tolist(), len(order)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a == b:
            continue
        key = [n[int(c[a])] for n, c in zip(names, codes, strict=True)]
        for lo, hi in chunks(offsets[a:b + 1], CHUNK):
            for at in range(a + lo, a + hi, MOST_DOCUMENTS):
                to = min(a + hi, at + MOST_DOCUMENTS)
                part = data[offsets[at]:offsets[to]]
                part = part + np.where((part >= 0x41) & (part <= 0x5A), np.uint8(0x20), np.uint8(0))
                yield key, part, offsets[at:to + 1] - offsets[at]


def prefix_level(docs: DataFrame, size: int, before: int, shared, least: int) -> DataFrame:
    """(lang, prefix, docs) of the prefixes of ``size`` bytes that at least
    ``least`` documents hold, among terms whose shorter prefix was left."""

    def short(batches):
        bloom = shared and BlockedBloom(shared.value)
        for batch in batches:
            for (lang,), data, offsets in _segments(batch, (0,)):
                found, n = np.unique(short_prefixes(data, offsets, size) & _HIGH[6], return_counts=True)
                above, at = np.unique(found & _HIGH[before], return_inverse=True)
                keep = _held(prefix_bytes(above), hash_bytes(pa.array([lang]))[0], bloom)[at]
                found, n = found[keep], n[keep]
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(n), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                                                 names=["lang", "prefix", "docs"])

    def long(batches):
        bloom = shared and BlockedBloom(shared.value)
        for batch in batches:
            for (lang,), data, offsets in _segments(batch, (0,)):
                t = Terms(data, offsets)
                above, of_term = t.prefixes(before)
                keep = _held(above, hash_bytes(pa.array([lang]))[0], bloom)[of_term][t.term]
                texts, of_term = t.prefixes(size)
                width = max(1, len(texts))
                once = _distinct(t.doc[keep] * width + of_term[t.term[keep]])       # once a document
                n = np.bincount(once % width, minlength=len(texts))
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(some), pa.string()), texts.take(pa.array(some)).cast(pa.binary()),
                                                  pa.array(n[some])], names=["lang", "prefix", "docs"])

    small = size <= 6
    found = in_batches(docs, short if small else long, f"lang string, prefix {'long' if small else 'binary'}, docs long")
    left = found.groupBy("lang", "prefix").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    # the first byte is a letter or above, so hex() has all 16 digits
    return left.withColumn("prefix", F.unhex(F.regexp_replace(F.hex("prefix"), "(?:00)+$", ""))) if small else left


def _prefix_filter(level: DataFrame, most_bytes: int) -> np.ndarray:
    def work(batches):
        for batch in batches:
            names, lang = _codes(batch.column(0))
            keys = mix(hash_bytes(batch.column(1)) ^ mix(hash_bytes(names))[lang]) if batch.num_rows else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    return BlockedBloom.build(staged(in_batches(level.select("lang", "prefix"), work, "key long"), "prefix-keys"),
                              most_bytes=most_bytes).blocks


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS, levels: tuple[int, ...] = LEVELS,
               most_bytes: int = MOST_BYTES) -> DataFrame:
    """(lang, term, docs, n, per_source array<struct<source, n>>) of the kept
    terms: documents and occurrences in the language, occurrences by source."""
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shared, before = None, 0
    for size in levels:
        left = prefix_level(rows, size, before, shared, least)
        shared, before = spark.sparkContext.broadcast(_prefix_filter(left, most_bytes)), size

    def work(batches):
        bloom = shared and BlockedBloom(shared.value)
        for batch in batches:
            for (lang, source), data, offsets in _segments(batch, (0, 1)):
                t = Terms(data, offsets)
                above, of_term = t.prefixes(before)
                keep = np.flatnonzero(_held(above, hash_bytes(pa.array([lang]))[0], bloom)[of_term])
                docs_of, total = np.bincount(t.term, minlength=len(t.terms)), np.zeros(len(t.terms), np.int64)
                np.add.at(total, t.term, t.count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()] * len(keep), pa.string()), pa.array([source.as_py()] * len(keep), pa.string()),
                     t.terms.take(pa.array(keep)).cast(pa.large_string()).cast(pa.string()), pa.array(docs_of[keep]), pa.array(total[keep])],
                    names=["lang", "source", "term", "docs", "n"])

    counts = in_batches(rows, work, "lang string, source string, term string, docs long, n long")
    per_group = counts.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    return per_group.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("per_source"), F.sum("n").alias("n")).where(
        F.col("docs") >= least).select("lang", "term", "docs", "n", "per_source")


def _value(count: Column, total: str) -> Column:
    """1 + floor(SCALE (count + 1) / (total + V)); decimal, as counts may be huge."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", top, (F.col(total) + F.col("v")).cast("decimal(20,0)")) + 1


def divergence(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q) in integers."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _shared_terms(weights: DataFrame) -> DataFrame:
    """(lang, source, item, value): for terms that both sources hold, what the
    sums over single sources miss.  Rows of a term lie together, so a batch's pairs
    are formed a bounded number at a time."""

    def f(p, q):
        return (p - q) * (p - q) // q

    def work(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            whole, held = _split_last(table)
            yield from _pair_sums(whole)
        if held is not None:
            yield from _pair_sums(held)

    def _boundaries(table):
        lang, term = (_codes(table.column(c).combine_chunks())[1] for c in ("lang", "term"))
        new = np.ones(table.num_rows, dtype=bool)
        new[1:] = (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])
        return np.flatnonzero(new)

    def _split_last(table):
        last = int(_boundaries(table)[-1])
        return table.slice(0, last), table.slice(last)

    def _pair_sums(table):
        if not table.num_rows:
            return
        heads = _boundaries(table)
        size = np.diff(np.append(heads, table.num_rows))
        head, size = np.repeat(heads, size), np.repeat(size, size)
        langs, lang = _codes(table.column("lang").combine_chunks())
        sources, source = _codes(table.column("source").combine_chunks())
        p, p0 = (table.column(c).to_numpy() for c in ("p", "p0"))
        n = len(sources)
        cuts = np.searchsorted(np.cumsum(size), np.arange(PAIRS, int(size.sum()) + PAIRS, PAIRS)) + 1
        lo, found = 0, []
        for hi in np.unique(cuts.clip(max=len(size))).tolist():
            i = np.repeat(np.arange(lo, hi), size[lo:hi])
            j = ranges(head[lo:hi], size[lo:hi])
            lo = hi
            i, j = i[i != j], j[i != j]
            value = f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
            key, at = np.unique((lang[i] * n + source[i]) * n + source[j], return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, at, value)
            found.append((key, total))
        for key, total in found:
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(key // n // n)), sources.take(pa.array(key // n % n)), sources.take(pa.array(key % n)), pa.array(total)],
                names=["lang", "source", "item", "value"])

    together = weights.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return in_batches(together, work, "lang string, source string, item string, value long")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, levels: tuple[int, ...] = LEVELS,
          most_bytes: int = MOST_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each group of documents is
    from the other sources of its language, and by which terms from the language."""
    kept = staged(kept_terms(docs, least, levels, most_bytes), "kept-terms")
    per_source = kept.select("lang", "term", F.col("n").alias("n_lang"), F.explode("per_source").alias("s")).select(
        "lang", "term", "n_lang", F.col("s.source").alias("source"), F.col("s.n").alias("n"))
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("total_lang"))
    totals = per_source.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(languages, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "total_lang")])
    # the value of a term that the group does not hold; without kept terms there are none
    groups = staged(groups.withColumn("p0", F.when(F.col("v") > 0, _value(F.lit(0), "total")).otherwise(F.lit(1))), "groups")
    weights = staged(per_source.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", _value(F.col("n"), "total").alias("p"), "p0", _value(F.col("n_lang"), "total_lang").alias("q")), "weights")

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("o0"))
    base = groups.join(other, "lang").where("source != item").select(
        "lang", "source", "item", (F.col("v") * divergence("p0", "o0")).alias("value"))
    values = weights.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    met = values.join(other, "lang").where("source != item")
    as_first = met.select("lang", "source", "item", (F.col("n") * (divergence("p", "o0") - divergence("p0", "o0"))).alias("value"))
    as_second = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                           (F.col("n") * (divergence("o0", "p") - divergence("o0", "p0"))).alias("value"))
    pairs = base.unionByName(as_first).unionByName(as_second).unionByName(_shared_terms(weights)).groupBy(
        "lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    terms = weights.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value"))
    order = [F.col("value").desc(), F.col("item").asc()]
    group = ["lang", "source"]
    ranked = top_k(terms, group, order, top).withColumn("part", F.lit("term"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return pairs.unionByName(ranked).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
