"""Okapi BM25 over a document-clustered index.

``Bm25Index.build`` reads the text once and stages:

* ``docs``   (doc_id, pos, doc_len, terms array<struct<term, tf>>) -- one row per
  document, bucketed by doc_id.  Terms are counted inside the row (run lengths of
  the sorted tokens), so neither the text nor (document, term) pairs are shuffled
  to count them.
* ``terms``  (term, df, raw_idf, idf) -- idf = ln(N-df+0.5) - ln(df+0.5);
  negative values are floored to ``epsilon * mean(raw_idf)``.

N, the average length and the mean idf are read from these small tables and held
as literals.  A search stages the query weights (term, query_id, qtf * idf) -- a
table whose size Catalyst knows, hence a broadcast while it is small -- joins
them to the exploded rows and sums per (query, document).  The rows of a
document are clustered already, so the sum needs no exchange, and the partial
top-k (WindowGroupLimit) leaves about k rows per query and task to shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bm25_document_text, bm25_tokens, with_term_counts
from .common import attach_fields, document_buckets, exact_mean, lookup, need_index, rank_padded, score_key, stage, stage_by_document


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, qtf): tokenized queries, a repeated token counted."""
    return (queries.select("query_id", F.explode(bm25_tokens("query")).alias("term"))
            .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


class Bm25Index:
    def __init__(self, corpus: DataFrame | None = None, docs: DataFrame | None = None, terms: DataFrame | None = None,
                 stats: dict | None = None, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25):
        self.corpus, self.docs = corpus, docs
        self.k1, self.b, self.epsilon = float(k1), float(b), float(epsilon)
        if docs is None:            # not built yet: search and explain raise
            return
        self._terms, self._stats = terms, stats
        self.n_docs, self.avgdl, self.average_idf = (F.lit(stats[c]) for c in ("n_docs", "avgdl", "average_idf"))
        self.terms = terms.withColumn("idf", F.when(F.col("raw_idf") < 0, F.lit(self.epsilon) * self.average_idf)
                                      .otherwise(F.col("raw_idf")))
        self.postings = docs.select("doc_id", "pos", "doc_len", F.explode("terms").alias("t")).select(
            "doc_id", "pos", "doc_len", F.col("t.term").alias("term"), F.col("t.tf").alias("tf"))
        self.doc_lengths = docs.select("doc_id", "pos", "doc_len")
        self.stats = self.doc_lengths.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("doc_len").alias("avgdl"),
                                          F.sum("doc_len").alias("n_tokens"))

    # ------------------------------------------------------------------ build
    @classmethod
    def build(cls, corpus: DataFrame, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25,
              path: str | None = None) -> Bm25Index:
        """Tokenize ``title + " " + text`` and stage the index (below ``path``,
        or in a new folder under ``spark.checkpoint.dir``).  A null text or an
        empty corpus is a ``ValueError``."""
        base = path.rstrip("/") if path else None
        tokens = bm25_tokens(bm25_document_text("title", "text"))
        rows = corpus.select("doc_id", "pos", "title", "text")
        buckets = document_buckets(rows)         # the text goes to its bucket, it is half as large as its counts
        counted = with_term_counts(rows.repartition(buckets, "doc_id").select("doc_id", "pos", tokens.alias("tokens")), "tokens", "terms")
        docs = stage_by_document(counted.select("doc_id", "pos", F.when(F.col("tokens").isNotNull(), F.size("tokens"))
                                                .alias("doc_len"), "terms"), "bm25-docs", base and f"{base}/docs", buckets)
        row = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_len").alias("with_text"),
                       F.avg("doc_len").alias("avgdl")).first()
        if not row["n"]:
            raise ValueError("the corpus has no documents")
        if row["with_text"] < row["n"]:
            raise ValueError(f"{row['n'] - row['with_text']} documents have no text")
        n = F.lit(int(row["n"]))
        df = docs.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        raw = df.withColumn("raw_idf", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
        terms = stage(raw, "bm25-terms", base and f"{base}/terms")
        # Exact mean: a DECIMAL sum does not depend on partitioning or order.
        mean = terms.agg(exact_mean("raw_idf").alias("a")).first()["a"]
        stats = {"n_docs": int(row["n"]), "avgdl": float(row["avgdl"]), "average_idf": float(mean or 0.0)}
        return cls(corpus, docs, terms, stats, k1, b, epsilon)

    def with_params(self, k1: float | None = None, b: float | None = None) -> Bm25Index:
        """Same index, other (k1, b): what is staged does not depend on them."""
        return Bm25Index(self.corpus, self.docs, self._terms, self._stats, self.k1 if k1 is None else k1,
                         self.b if b is None else b, self.epsilon)

    # ---------------------------------------------------------------- scoring
    def _term_score(self, idf: Column, tf: Column, doc_len: Column, k1: float | None = None, b: float | None = None) -> Column:
        k1, b = F.lit(self.k1 if k1 is None else float(k1)), F.lit(self.b if b is None else float(b))
        norm = tf + k1 * (F.lit(1.0) - b + b * doc_len / self.avgdl)
        return idf * ((tf * (k1 + F.lit(1.0))) / norm)

    def negative_floor(self) -> bool:
        """True when the idf floor is negative (mean raw idf < 0), the only
        case with negative scores."""
        return self._stats["average_idf"] < 0

    def _weights(self, queries: DataFrame) -> DataFrame:
        need_index(self.docs, "search")
        return stage(self.terms.select("term", "idf").join(query_terms(queries), "term"), "bm25-query")

    def score(self, queries: DataFrame) -> DataFrame:
        """(query_id, doc_id, pos, bm25_score) for every document sharing a
        term with the query (including score 0 when only idf-0 terms match)."""
        weights = self._weights(queries)
        contribution = F.col("qtf") * self._term_score(F.col("idf"), F.col("tf"), F.col("doc_len"))
        return (self.postings.join(weights, "term").groupBy("query_id", "doc_id", "pos")
                .agg(F.sum(contribution).alias("bm25_score")))

    def search(self, queries: DataFrame, k: int = 5, fields: bool = False) -> DataFrame:
        """Top-k per query: (query_id, rank, doc_id, pos, bm25_score[, corpus fields]).

        Every document is ranked, as in the reference: when a query has fewer
        than k non-zero scores, zero-score documents fill the list in corpus
        order.  Those can only come from the first ``k + m`` documents by pos
        (m = negative-score matches, 0 unless the idf floor is negative), so
        the padding is a bounded scalar-subquery array exploded per query,
        minus the documents that already have a non-zero score."""
        if k < 0:
            raise ValueError("top_k must be >= 0")
        ranked = self._ranked(queries, self.score(queries), k)
        return attach_fields(ranked, self.corpus) if fields else ranked

    def _ranked(self, queries: DataFrame, scored: DataFrame, k: int) -> DataFrame:
        depth = k
        if self.negative_floor():
            scored = stage(scored, "bm25-scores")
            neg = (scored.where(score_key("bm25_score") < 0).groupBy("query_id").count()
                   .agg(F.max("count")).first()[0])
            depth += int(neg or 0)
        return rank_padded(queries, scored, self.doc_lengths, k, "bm25_score",
                           depth=depth, keep_all_nonzero=self.negative_floor())

    def sweep(self, queries: DataFrame, params: Sequence[tuple[float, float]], k: int = 5) -> DataFrame:
        """Top-k per query for every (k1, b) of ``params``: (k1, b, query_id, rank,
        doc_id, pos, bm25_score), as ``with_params(k1, b).search`` gives them.  The
        index is read once: a (query, document) row sums the contributions under
        all parameters side by side, and each pair keeps k rows per query and task."""
        if k < 0:
            raise ValueError("top_k must be >= 0")
        need_index(self.docs, "search")
        sums = [F.sum(F.col("qtf") * self._term_score(F.col("idf"), F.col("tf"), F.col("doc_len"), k1, b)).alias(f"_s{i}")
                for i, (k1, b) in enumerate(params)]
        wide = self.postings.join(self._weights(queries), "term").groupBy("query_id", "doc_id", "pos").agg(*sums)
        # the pair's number becomes part of the query's key
        scored = wide.select("query_id", "doc_id", "pos", F.posexplode(F.array(*[F.col(f"_s{i}") for i in range(len(params))]))
                             .alias("i", "bm25_score")).withColumn("query_id", F.struct("i", F.col("query_id").alias("q")))
        numbers = F.explode(F.array(*[F.lit(i) for i in range(len(params))])).alias("i")
        asked = queries.select(numbers, F.col("query_id").alias("q")).select(F.struct("i", "q").alias("query_id"))
        pair = F.get(F.array(*[F.struct(F.lit(float(k1)).alias("k1"), F.lit(float(b)).alias("b")) for k1, b in params]), F.col("query_id.i"))
        return self._ranked(asked, scored, k).select(pair["k1"].alias("k1"), pair["b"].alias("b"), F.col("query_id.q").alias("query_id"),
                                                     "rank", "doc_id", "pos", "bm25_score")

    # ---------------------------------------------------------------- explain
    def _pair_terms(self, pairs: DataFrame) -> DataFrame:
        """(query_id, doc_id, term) per distinct query token of each pair
        (term NULL for a query without tokens), staged once."""
        need_index(self.docs, "explain")
        return stage(pairs.select("query_id", "doc_id", F.explode_outer(F.array_distinct(bm25_tokens("query")))
                                  .alias("term")), "explain-terms")

    def _explain_long(self, pt: DataFrame) -> DataFrame:
        in_row = F.filter("terms", lambda t: t["term"] == F.col("term"))
        known = (self.docs.join(pt.where(F.col("term").isNotNull()), "doc_id")
                 .select("query_id", "doc_id", "term", "doc_len", F.get(in_row, F.lit(0))["tf"].alias("tf")))
        idf = lookup(pt, self.terms, ["term"]).select("term", "idf")
        contrib = self._term_score(F.col("idf"), F.col("tf"), F.col("doc_len"))
        return known.join(idf, "term", "left").select(
            "query_id", "doc_id", "term", F.coalesce(contrib, F.lit(0.0)).alias("contribution"))

    def explain_terms(self, pairs: DataFrame) -> DataFrame:
        """Long form: (query_id, doc_id, term, contribution) for every distinct
        query term and every *known* document; OOV or absent terms give 0.0."""
        return self._explain_long(self._pair_terms(pairs))

    def explain(self, pairs: DataFrame) -> DataFrame:
        """One row per (query_id, query, doc_id) pair: query_tokens (duplicates
        kept), doc_token_count, term_contributions map, total_score (sum over
        distinct terms) and ``error`` for an unknown document."""
        pt = self._pair_terms(pairs)
        lengths = lookup(pt, self.doc_lengths, ["doc_id"]).select("doc_id", F.col("doc_len").alias("dl"))
        per_pair = (self._explain_long(pt).groupBy("query_id", "doc_id")
                    .agg(F.map_from_entries(F.collect_list(F.struct("term", "contribution"))).alias("tc"),
                         F.sum("contribution").alias("ts")))
        base = (pairs.select("query_id", "doc_id", bm25_tokens("query").alias("query_tokens"))
                .join(lengths, "doc_id", "left")
                .join(per_pair, ["query_id", "doc_id"], "left"))
        found = F.col("dl").isNotNull()
        empty_map = F.create_map().cast("map<string,double>")
        return base.select(
            "query_id", "doc_id",
            F.when(found, F.col("query_tokens")).alias("query_tokens"),
            F.col("dl").cast("int").alias("doc_token_count"),
            F.when(found, F.coalesce(F.col("tc"), empty_map)).alias("term_contributions"),
            F.when(found, F.coalesce(F.col("ts"), F.lit(0.0))).alias("total_score"),
            F.when(~found, F.concat(F.lit("Document "), F.col("doc_id").cast("string"), F.lit(" not found")))
            .alias("error"))
