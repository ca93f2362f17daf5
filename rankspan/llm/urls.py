"""URL filter: a blocked Bloom filter before an exact hash join.

The list holds canonical URLs: a host (A-Z lower-cased), a path and a verdict
each.  An entry fits its host and all subdomains where the path starts with the
entry's path.  So a URL can only be named by one of its *keys*: the last m labels
of its host with the first c characters of its path.  Only the (m, c) that occur
in the list are formed; their number is bounded by the labels of a host times
the length of the longest listed path, however many entries there are.

1. Every URL's keys are tested against a blocked Bloom filter of the listed keys
   (bounded in size, broadcast).  Most URLs of a crawl end here, without a shuffle.
2. The distinct URLs with possible hits meet the list in an equi-join on host and
   path, which removes the false positives; the longest entry counts (of equally
   long ones that with the longer host).
3. The decisions return to the rows by URL, in a join whose hot keys Spark can split.

``listed`` adds whole canonical URLs that are blocked by themselves: host without
the default port, path ('/' if empty), query without tracking parameters in
sorted order, no scheme, no fragment.  They go through the same filter and join.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
fits no entry (but that of an empty host, if listed); URLs that nothing names get
``default``; repeated rows are judged alike; null ids and extra columns (any
name) are allowed; an empty list gives every row ``default``.
"""

from __future__ import annotations

import string
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import MOST_BYTES, BlockedBloom
from .common import in_batches, staged

# Query parameters that do not name a page.
TRACKING = r"^(?:utm_[a-z_]+|ref|fbclid|gclid|mc_cid|mc_eid)(?:=|$)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first '://' (empty without one)."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = _rest(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def canonical(url: Column) -> Column:
    """Canonical text of a whole URL (null without '://')."""
    host, path = host_and_path(url)
    host = F.regexp_replace(host, r"\.?(?::(?:80|443))?$", "")
    query = F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    text = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(F.size(kept) > 0, F.lit("?")).otherwise(F.lit("")),
                    F.array_join(kept, "&"))
    return F.when(F.instr(url, "://") > 0, text)


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def _key_of(host: Column, path: Column, shape: Column) -> tuple[Column, Column]:
    """The key of ``shape`` (labels, characters) of a URL."""
    labels = _labels(host)
    return (F.array_join(F.slice(labels, F.size(labels) - shape["labels"] + 1, shape["labels"]), "."),
            F.substring(path, F.lit(1), shape["size"]))


def _entries(rules: DataFrame) -> DataFrame:
    """(host, path, verdict, rule) of the list; nulls as empty, repeats once
    (of contradictory verdicts the smaller text counts)."""
    host, path = lower_ascii(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    return (rules.select(host.alias("rule_host"), path.alias("rule_path"), "verdict").groupBy("rule_host", "rule_path")
            .agg(F.min("verdict").alias("rule_verdict")))


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, id_col: str = "page_id",
                url_col: str = "url", default: str = "allow", most_bytes: int = MOST_BYTES) -> DataFrame:
    """(id_col, host, path, rule, verdict) of every row of ``pages``.

    rules: (host, path, verdict); listed: (url), each blocked as a whole where no
    rule fits.  ``rule`` is the host and path of the entry that decided."""
    spark = pages.sparkSession
    entries = staged(_entries(rules), "url-rules")
    shapes = sorted((r["labels"], r["size"]) for r in entries.select(
        F.size(_labels(F.col("rule_host"))).alias("labels"), F.length("rule_path").alias("size")).distinct().collect())
    whole = None if listed is None else staged(listed.select(canonical(F.col("url")).alias("listed")).where(
        "listed IS NOT NULL").distinct(), "url-listed")
    keys = entries.select(F.xxhash64("rule_host", "rule_path").alias("key"))
    if whole is not None:
        keys = keys.unionByName(whole.select(F.xxhash64("listed").alias("key")))
    shared = spark.sparkContext.broadcast(BlockedBloom.build(keys, most_bytes=most_bytes).blocks)

    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", host.alias("host"), path.alias("path"),
        (F.lit(None).cast("string") if whole is None else canonical(F.col("url"))).alias("canonical"))
    options = F.array(*[F.struct(F.lit(m).alias("labels"), F.lit(c).alias("size"), F.lit(i).alias("i"))
                        for i, (m, c) in enumerate(shapes)]) if shapes else F.array().cast("array<struct<labels:int,size:int,i:int>>")
    h, p = F.col("host"), F.col("path")
    fitting = F.filter(options, lambda s: (s["labels"] <= F.size(_labels(h))) & (s["size"] <= F.length(p)))
    probes = F.transform(fitting, lambda s: F.struct(s["i"].alias("i"), F.xxhash64(*_key_of(h, p, s)).alias("key")))
    own = F.struct(F.lit(-1).alias("i"), F.xxhash64("canonical").alias("key"))
    if whole is not None:
        probes = F.concat(probes, F.when(F.col("canonical").isNotNull(), F.array(own)).otherwise(
            F.array().cast("array<struct<i:int,key:bigint>>")))
    probed = rows.withColumn("probes", probes).select("id", "host", "path", "canonical", F.col("probes.i").alias("i"),
                                                      F.col("probes.key").alias("keys"))

    def work(batches):
        bloom = BlockedBloom(shared.value)
        for batch in batches:
            at, keys = batch.column(4), batch.column(5)
            ends = keys.offsets.to_numpy().astype(np.int64)
            flat = keys.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
            which = at.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
            passed = bloom.may_hold(flat)
            to = np.concatenate([[0], np.cumsum(passed)])[ends - ends[0]]
            hits = pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(which[passed].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], hits], names=["id", "host", "path", "canonical", "hits"])

    kind = dict(rows.dtypes)["id"]
    marked = staged(in_batches(probed, work, f"id {kind}, host string, path string, canonical string, hits array<int>"), "url-hits")
    named = ["host", "path", "canonical"]
    possible = marked.where(F.size("hits") > 0)
    asked = possible.select(*named, F.explode("hits").alias("i")).distinct()
    parts = []
    if shapes:
        shape = F.get(options, F.col("i"))
        rule_h, rule_p = _key_of(h, p, shape)
        parts.append(asked.where("i >= 0").select(*named, rule_h.alias("rule_host"), rule_p.alias("rule_path"))
                     .join(entries, ["rule_host", "rule_path"])
                     .select(*named, F.struct((F.length("rule_host") + F.length("rule_path")).alias("long"), F.length("rule_host").alias("hl"),
                                              F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")).alias("best")))
    if whole is not None:
        parts.append(asked.where("i < 0").join(whole, F.col("canonical") == F.col("listed")).select(*named, F.struct(
            F.lit(-1).alias("long"), F.lit(-1).alias("hl"), F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict")).alias("best")))
    out = [id_col, "host", "path", "rule", "verdict"]
    plain = marked.where(F.size("hits") == 0).select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                                                     F.lit(default).alias("verdict"))
    if not parts:
        return plain.select(*out)
    best = reduce(DataFrame.unionByName, parts).groupBy(*named).agg(
        F.max_by("best", F.struct("best.long", "best.hl")).alias("best")).select(
        F.col("host").alias("bh"), F.col("path").alias("bp"), F.col("canonical").alias("bc"), "best")
    decided = possible.join(best, (F.col("host") == F.col("bh")) & (F.col("path") == F.col("bp"))
                            & F.col("canonical").eqNullSafe(F.col("bc")), "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
    return plain.select(*out).unionByName(decided.select(*out))
