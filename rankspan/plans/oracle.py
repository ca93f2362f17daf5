"""Independent DuckDB statements for the registered workloads.

Written from the operator semantics (brute force where that is simpler: every
query is scored against every document), not from the Spark plans.  Tables
``documents``, ``benchmark``, ``embeddings`` ... are views over the same
Parquet files.  Every literal used in arithmetic is cast to DOUBLE so DuckDB
does not fall back to DECIMAL arithmetic.
"""

from __future__ import annotations

import string

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..functions.text import WHITESPACE_RUN, WORD_RUN

PUNCT_SQL = string.punctuation.replace("'", "''")
TOP_K = 5
FETCH_K = 15
SWEEP = ((1.2, 0.0), (2.0, 1.0))


def d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def bm25_tok(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(translate(lower({x}), '{PUNCT_SQL}', ''), '{WHITESPACE_RUN}'), "
            f"lambda t: length(t) > 1)")


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS) + "]"

QS = "qs AS (SELECT item_id AS query_id, text AS query FROM benchmark)"

BM25_INDEX = f"""
btok AS (SELECT doc_id, doc_id AS pos, {bm25_tok("' ' || text")} AS tokens FROM documents),
blen AS (SELECT doc_id, pos, len(tokens) AS doc_len FROM btok),
bstats AS (SELECT count(*) AS n_docs, avg(doc_len) AS avgdl, sum(doc_len) AS n_tokens FROM blen),
bpost AS (SELECT doc_id, pos, doc_len, term, count(*) AS tf
          FROM (SELECT doc_id, pos, len(tokens) AS doc_len, unnest(tokens) AS term FROM btok) GROUP BY ALL),
bdf AS (SELECT term, count(*) AS df FROM bpost GROUP BY term),
braw AS (SELECT term, df, ln(n_docs - df + {d(0.5)}) - ln(df + {d(0.5)}) AS raw_idf FROM bdf, bstats),
bterms AS (SELECT term, df, raw_idf,
                  CASE WHEN raw_idf < 0 THEN {d(0.25)} * (SELECT CAST(sum(CAST(raw_idf AS DECIMAL(38,18))) AS DOUBLE) / count(raw_idf) FROM braw) ELSE raw_idf END AS idf
           FROM braw)"""

BM25_QUERY = f"""
bq AS (SELECT query_id, term, count(*) AS qtf
       FROM (SELECT query_id, unnest({bm25_tok('query')}) AS term FROM qs) GROUP BY ALL)"""


def bm25_contrib(k1: float, b: float, tf="p.tf", dl="p.doc_len", idf="t.idf") -> str:
    return (f"{idf} * (({tf} * ({d(k1)} + {d(1.0)})) / "
            f"({tf} + {d(k1)} * ({d(1.0)} - {d(b)} + {d(b)} * {dl} / s.avgdl)))")


def bm25_ranked(k1: float = 1.5, b: float = 0.75, name: str = "branked") -> str:
    """All documents scored for all queries, ranked desc score, asc pos."""
    return f"""
{name}_s AS (SELECT q.query_id, p.doc_id, sum(q.qtf * {bm25_contrib(k1, b)}) AS score
        FROM bq q JOIN bterms t USING (term) JOIN bpost p USING (term) CROSS JOIN bstats s GROUP BY ALL),
{name} AS (SELECT query_id, doc_id, pos, bm25_score,
                  row_number() OVER (PARTITION BY query_id ORDER BY round(bm25_score, 9) + {d(0)} DESC, pos ASC) AS rank
           FROM (SELECT qs.query_id, l.doc_id, l.pos, coalesce(x.score, {d(0)}) AS bm25_score
                 FROM qs CROSS JOIN blen l LEFT JOIN {name}_s x ON x.query_id = qs.query_id AND x.doc_id = l.doc_id))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


ORACLE: dict[str, str] = {}

ORACLE["tokenize"] = f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {bm25_tok("' ' || text")} AS t FROM documents)"""

ORACLE["term_frequency"] = _with(BM25_INDEX) + "\nSELECT doc_id, term, CAST(tf AS BIGINT) AS tf FROM bpost"
ORACLE["doc_length"] = _with(BM25_INDEX) + "\nSELECT doc_id, CAST(doc_len AS BIGINT) AS doc_len FROM blen"
ORACLE["corpus_stats"] = _with(BM25_INDEX) + (
    "\nSELECT CAST(n_docs AS BIGINT) AS n_docs, round(avgdl, 6) AS avgdl, CAST(n_tokens AS BIGINT) AS n_tokens "
    "FROM bstats")
ORACLE["document_frequency"] = _with(BM25_INDEX) + "\nSELECT term, CAST(df AS BIGINT) AS df FROM bterms"
ORACLE["bm25_idf"] = _with(BM25_INDEX) + (
    "\nSELECT term, CAST(df AS BIGINT) AS df, round(raw_idf, 6) AS raw_idf, round(idf, 6) AS idf FROM bterms")
ORACLE["query_terms"] = _with(QS, BM25_QUERY) + "\nSELECT query_id, term, CAST(qtf AS BIGINT) AS qtf FROM bq"

ORACLE["bm25_search"] = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked()) + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round(bm25_score, 6) AS bm25_score
FROM branked WHERE rank <= {TOP_K}"""

# an index that was stored, opened, appended to gives what a new one gives
ORACLE["bm25_reopened"] = ORACLE["bm25_appended"] = ORACLE["bm25_search"]
ORACLE["bm25_deleted"] = _with(QS, "left_docs AS (SELECT * FROM documents WHERE source IS NULL OR source != 'src0')",
                               BM25_INDEX.replace("FROM documents", "FROM left_docs"), BM25_QUERY, bm25_ranked()) + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round(bm25_score, 6) AS bm25_score
FROM branked WHERE rank <= {TOP_K}"""

# two queries per item that few documents or none match
SPARSE_QS = f"""qs AS (SELECT item_id * 2 AS query_id, list_max({bm25_tok('text')}) AS query FROM benchmark
       UNION ALL SELECT item_id * 2 + 1, regexp_replace(text, '[ \n]+', '', 'g') FROM benchmark)"""
ORACLE["bm25_search_padded"] = _with(SPARSE_QS, BM25_INDEX, BM25_QUERY, bm25_ranked()) + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round(bm25_score, 6) AS bm25_score
FROM branked WHERE rank <= {FETCH_K}"""

ORACLE["bm25_search_fields"] = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked()) + f"""
SELECT r.query_id, CAST(r.rank AS BIGINT) AS rank, r.doc_id, round(r.bm25_score, 6) AS bm25_score,
       d.lang, d.source, d.n_chars
FROM branked r JOIN documents d USING (doc_id) WHERE r.rank <= {TOP_K}"""

ORACLE["bm25_k1_b"] = _with(QS, BM25_INDEX, BM25_QUERY, *(bm25_ranked(k1, b, f"sw{i}") for i, (k1, b) in
                                                          enumerate(SWEEP))) + "\n" + "\nUNION ALL\n".join(
    f"SELECT {d(k1)} AS k1, {d(b)} AS b, query_id, CAST(rank AS BIGINT) AS rank, doc_id, "
    f"round(bm25_score, 6) AS bm25_score FROM sw{i} WHERE rank <= {TOP_K}" for i, (k1, b) in enumerate(SWEEP))

_EXPLAIN_PAIRS = """
pairs AS (SELECT query_id, doc_id FROM branked WHERE rank = 1
          UNION ALL SELECT query_id, CAST(-1 AS BIGINT) AS doc_id FROM qs),
pterms AS (SELECT DISTINCT p.query_id, p.doc_id, unnest(x.toks) AS term
           FROM pairs p JOIN (SELECT query_id, """ + bm25_tok("query") + """ AS toks FROM qs) x USING (query_id)
           WHERE p.doc_id IN (SELECT doc_id FROM blen)),
pcontrib AS (SELECT pt.query_id, pt.doc_id, pt.term,
                    coalesce(""" + bm25_contrib(1.5, 0.75, "p.tf", "p.doc_len", "t.idf") + """, """ + d(0) + """)
                      AS contribution
             FROM pterms pt LEFT JOIN bterms t USING (term)
             LEFT JOIN bpost p ON p.doc_id = pt.doc_id AND p.term = pt.term CROSS JOIN bstats s)"""

ORACLE["bm25_explain"] = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked(), _EXPLAIN_PAIRS) + """
SELECT query_id, doc_id, term, round(contribution, 6) AS contribution FROM pcontrib"""

ORACLE["bm25_explain_total"] = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked(), _EXPLAIN_PAIRS) + """
SELECT p.query_id, p.doc_id,
       CASE WHEN l.doc_id IS NOT NULL THEN CAST(len(""" + bm25_tok("q.query") + """) AS BIGINT) END AS n_query_tokens,
       CAST(l.doc_len AS BIGINT) AS doc_token_count,
       CASE WHEN l.doc_id IS NOT NULL THEN CAST(coalesce(c.n, 0) AS BIGINT) END AS n_terms,
       CASE WHEN l.doc_id IS NOT NULL THEN round(coalesce(c.total, """ + d(0) + """), 6) END AS total_score,
       CASE WHEN l.doc_id IS NULL THEN 'Document ' || CAST(p.doc_id AS VARCHAR) || ' not found' END AS error
FROM pairs p JOIN qs q USING (query_id) LEFT JOIN blen l USING (doc_id)
LEFT JOIN (SELECT query_id, doc_id, count(*) AS n, sum(contribution) AS total FROM pcontrib GROUP BY ALL) c
       ON c.query_id = p.query_id AND c.doc_id = p.doc_id"""

ORACLE["bm25_explain_missing"] = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked(), _EXPLAIN_PAIRS) + """
SELECT p.query_id, p.doc_id, 'Document ' || CAST(p.doc_id AS VARCHAR) || ' not found' AS error
FROM pairs p WHERE p.doc_id NOT IN (SELECT doc_id FROM blen)"""

ORACLE["qrels"] = """
SELECT DISTINCT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)"""


# --------------------------------------------------------------------------- tf-idf
def vec_words(x: str) -> str:
    return f"list_filter(regexp_extract_all(lower({x}), '{WORD_RUN}'), lambda t: NOT list_contains({STOP_SQL}, t))"


def uni_bigrams(w: str) -> str:
    return f"list_concat({w}, list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"


def l2_rows(src: str, key: str) -> str:
    return (f"w / sqrt(CAST(sum(CAST(w * w AS DECIMAL(38,18))) OVER (PARTITION BY {key}) AS DOUBLE))")


TFIDF_INDEX = f"""
vtok AS (SELECT doc_id, doc_id AS pos, {vec_words("'. ' || text")} AS w FROM documents),
vgram AS (SELECT doc_id, pos, {uni_bigrams('w')} AS g FROM vtok),
vtf AS (SELECT doc_id, pos, term, count(*) AS tf FROM (SELECT doc_id, pos, unnest(g) AS term FROM vgram) GROUP BY ALL),
vn AS (SELECT count(*) AS n FROM documents),
vdf AS (SELECT term, count(*) AS df FROM vtf GROUP BY term),
vvocab AS (SELECT term, df, ln(CAST(n + 1 AS DOUBLE) / CAST(df + 1 AS DOUBLE)) + {d(1)} AS idf
           FROM vdf, vn WHERE df >= 1 AND CAST(df AS DOUBLE) <= {d(0.95)} * n),
vw AS (SELECT t.doc_id, t.pos, t.term, ({d(1)} + ln(t.tf)) * v.idf AS w FROM vtf t JOIN vvocab v USING (term)),
vweights AS (SELECT doc_id, pos, term, {l2_rows('vw', 'doc_id')} AS weight FROM vw)"""

TFIDF_QUERY = f"""
qg AS (SELECT query_id, {uni_bigrams('w')} AS g FROM (SELECT query_id, {vec_words('query')} AS w FROM qs)),
qtf AS (SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest(g) AS term FROM qg) GROUP BY ALL),
qwv AS (SELECT q.query_id, q.term, ({d(1)} + ln(q.tf)) * v.idf AS w FROM qtf q JOIN vvocab v USING (term)),
qweights AS (SELECT query_id, term, {l2_rows('qwv', 'query_id')} AS weight FROM qwv)"""

TFIDF_RANKED = f"""
vs AS (SELECT q.query_id, w.doc_id, sum(q.weight * w.weight) AS score FROM qweights q JOIN vweights w USING (term)
       GROUP BY ALL),
vranked AS (SELECT query_id, doc_id, pos, vector_score,
                   row_number() OVER (PARTITION BY query_id ORDER BY round(vector_score, 9) + {d(0)} DESC, pos DESC)
                     AS rank
            FROM (SELECT qs.query_id, x.doc_id, x.doc_id AS pos, coalesce(vs.score, {d(0)}) AS vector_score
                  FROM qs CROSS JOIN documents x LEFT JOIN vs ON vs.query_id = qs.query_id AND vs.doc_id = x.doc_id))"""

ORACLE["ngrams"] = f"""
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_ngrams, array_to_string(g, '|') AS ngrams
FROM (SELECT doc_id, {uni_bigrams('w')} AS g FROM (SELECT doc_id, {vec_words("'. ' || text")} AS w FROM documents))"""
ORACLE["ngram_tf"] = _with(TFIDF_INDEX) + "\nSELECT doc_id, term, CAST(tf AS BIGINT) AS tf FROM vtf"
ORACLE["vocabulary"] = _with(TFIDF_INDEX) + "\nSELECT term, CAST(df AS BIGINT) AS df FROM vvocab"
ORACLE["tfidf_idf"] = _with(TFIDF_INDEX) + "\nSELECT term, CAST(df AS BIGINT) AS df, round(idf, 6) AS idf FROM vvocab"
ORACLE["tfidf"] = _with(TFIDF_INDEX) + "\nSELECT doc_id, term, round(weight, 6) AS weight FROM vweights"
ORACLE["tfidf_query"] = _with(QS, TFIDF_INDEX, TFIDF_QUERY) + (
    "\nSELECT query_id, term, round(weight, 6) AS weight FROM qweights")
ORACLE["top_terms"] = _with(QS, TFIDF_INDEX, TFIDF_QUERY) + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, term, round(weight, 6) AS weight
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(weight, 9) + {d(0)} DESC, term DESC) AS rank
      FROM qweights WHERE weight > 0) WHERE rank <= 10"""
ORACLE["tfidf_cosine_search"] = _with(QS, TFIDF_INDEX, TFIDF_QUERY, TFIDF_RANKED) + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round(vector_score, 6) AS vector_score
FROM vranked WHERE rank <= {TOP_K}"""


# --------------------------------------------------------------------------- dense vectors
EMB_UNIT = f"""
emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
unit AS (SELECT vec_id, CASE WHEN list_dot_product(v, v) > 0
                             THEN list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))
                             ELSE list_transform(v, lambda x: {d(0)}) END AS u FROM emb)"""

ORACLE["l2_normalize"] = _with(EMB_UNIT) + """
SELECT vec_id AS doc_id, CAST(generate_subscripts(u, 1) - 1 AS BIGINT) AS dim, round(unnest(u), 6) AS value FROM unit"""

ORACLE["dense_knn"] = _with(EMB_UNIT) + f"""
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round(vector_score, 6) AS vector_score
FROM (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, list_dot_product(a.u, b.u) AS vector_score,
             row_number() OVER (PARTITION BY a.vec_id
                                ORDER BY round(list_dot_product(a.u, b.u), 9) + {d(0)} DESC, b.vec_id DESC) AS rank
      FROM unit a CROSS JOIN unit b)
WHERE rank <= {TOP_K}"""


# --------------------------------------------------------------------------- fusion / hybrid
LINEAR_ALPHA = 0.7


def fetch_lists(depth: int, b: str = "bl", v: str = "vl") -> str:
    return f"""
{b} AS (SELECT query_id, doc_id, rank, bm25_score FROM branked WHERE rank <= {depth}),
{v} AS (SELECT query_id, doc_id, rank, vector_score FROM vranked WHERE rank <= {depth})"""


def rrf_sql(lists: list[tuple[str, str | None]], name: str = "rrf", k: float = 60.0) -> str:
    """lists: (cte, score column carried as a field or None)."""
    sel = []
    for i, (cte, score) in enumerate(lists):
        b = "bm25_score" if score == "bm25_score" else f"CAST(NULL AS DOUBLE)"
        v = "vector_score" if score == "vector_score" else f"CAST(NULL AS DOUBLE)"
        sel.append(f"SELECT {i} AS list_no, query_id, doc_id, rank, {b} AS bm25_score, {v} AS vector_score FROM {cte}")
    union = "\n    UNION ALL ".join(sel)
    return f"""
{name}_u AS ({union}),
{name}_g AS (SELECT query_id, doc_id, sum({d(1)} / ({d(k)} + rank)) AS s, min(list_no) AS first_list,
                    min(list_no * 1000000 + rank) AS first_seen,
                    max(CASE WHEN list_no = 0 THEN bm25_score END) AS b0,
                    max(CASE WHEN list_no = 0 THEN vector_score END) AS v0,
                    max(CASE WHEN list_no = 1 THEN bm25_score END) AS b1,
                    max(CASE WHEN list_no = 1 THEN vector_score END) AS v1
             FROM {name}_u GROUP BY query_id, doc_id),
{name} AS (SELECT query_id, doc_id, round(s, 6) AS rrf_score,
                  CASE WHEN first_list = 0 THEN b0 WHEN first_list = 1 THEN b1 END AS bm25_score,
                  CASE WHEN first_list = 0 THEN v0 WHEN first_list = 1 THEN v1 END AS vector_score,
                  row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, first_seen ASC) AS rank
           FROM {name}_g)"""


def linear_sql(alpha: float, b: str = "bl", v: str = "vl", name: str = "lin") -> str:
    return f"""
{name}_bb AS (SELECT query_id, min(bm25_score) AS bmin, max(bm25_score) - min(bm25_score) AS br FROM {b} GROUP BY query_id),
{name}_vb AS (SELECT query_id, min(vector_score) AS vmin, max(vector_score) - min(vector_score) AS vr
              FROM {v} GROUP BY query_id),
{name}_j AS (SELECT coalesce(x.query_id, y.query_id) AS query_id, coalesce(x.doc_id, y.doc_id) AS doc_id,
                    x.rank AS brank, y.rank AS vrank, x.bm25_score AS bsc, y.vector_score AS vsc
             FROM {b} x FULL OUTER JOIN {v} y ON x.query_id = y.query_id AND x.doc_id = y.doc_id),
{name}_s AS (SELECT j.query_id, j.doc_id, brank, vrank,
                    CASE WHEN vrank IS NULL THEN bsc END AS bm25_score, vsc AS vector_score,
                    round({d(alpha)} * ((coalesce(vsc, {d(0)}) - vmin) / (CASE WHEN vr = 0 THEN {d(1)} ELSE vr END))
                          + {d(1.0 - alpha)} * ((coalesce(bsc, {d(0)}) - bmin) / (CASE WHEN br = 0 THEN {d(1)} ELSE br END)),
                          6) AS linear_score
             FROM {name}_j j JOIN {name}_bb USING (query_id) JOIN {name}_vb USING (query_id)),
{name} AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY linear_score DESC, brank ASC NULLS LAST, vrank ASC)
                    AS rank FROM {name}_s)"""


BASE = (QS, BM25_INDEX, BM25_QUERY, bm25_ranked(), TFIDF_INDEX, TFIDF_QUERY, TFIDF_RANKED)


def _fused_sql(cte: str, score: str, extra=()) -> str:
    ex = "".join(f", round({c}, 6) AS {c}" for c in extra)
    return f"\nSELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round({score}, 6) AS {score}{ex} FROM {cte}"


ORACLE["rrf"] = _with(*BASE, fetch_lists(FETCH_K), rrf_sql([("bl", "bm25_score"), ("vl", "vector_score")])) + \
    _fused_sql("rrf", "rrf_score")
ORACLE["rrf_fields"] = _with(*BASE, fetch_lists(FETCH_K), rrf_sql([("bl", "bm25_score"), ("vl", "vector_score")])) + \
    _fused_sql("rrf", "rrf_score", ("bm25_score", "vector_score"))
ORACLE["rrf_three_lists"] = _with(
    *BASE, bm25_ranked(SWEEP[0][0], SWEEP[0][1], "sw0"), fetch_lists(FETCH_K),
    f"b2 AS (SELECT query_id, doc_id, rank FROM sw0 WHERE rank <= {FETCH_K})",
    rrf_sql([("bl", None), ("vl", None), ("b2", None)])) + _fused_sql("rrf", "rrf_score")
ORACLE["linear_fusion"] = _with(*BASE, fetch_lists(FETCH_K), linear_sql(0.5)) + _fused_sql("lin", "linear_score")
ORACLE["linear_fields"] = _with(*BASE, fetch_lists(FETCH_K), linear_sql(LINEAR_ALPHA)) + \
    _fused_sql("lin", "linear_score", ("bm25_score", "vector_score"))
ORACLE["minmax_normalize"] = _with(*BASE, fetch_lists(FETCH_K)) + f"""
SELECT query_id, 'bm25' AS list, round(min(bm25_score), 6) AS min_score,
       round(CASE WHEN max(bm25_score) - min(bm25_score) = 0 THEN {d(1)} ELSE max(bm25_score) - min(bm25_score) END, 6)
         AS score_range
FROM bl GROUP BY query_id
UNION ALL
SELECT query_id, 'vector' AS list, round(min(vector_score), 6) AS min_score,
       round(CASE WHEN max(vector_score) - min(vector_score) = 0 THEN {d(1)}
                  ELSE max(vector_score) - min(vector_score) END, 6) AS score_range
FROM vl GROUP BY query_id"""


def hybrid_sql(top_k: int, fusion: str = "rrf", alpha: float = 0.5) -> str:
    fetch = max(3 * top_k, 10)
    fuse = (rrf_sql([("bl", "bm25_score"), ("vl", "vector_score")], "fz") if fusion == "rrf"
            else linear_sql(alpha, name="fz"))
    hy_rrf = "rrf_score" if fusion == "rrf" else "CAST(NULL AS DOUBLE)"
    hy_lin = "linear_score" if fusion == "linear" else "CAST(NULL AS DOUBLE)"
    return _with(*BASE, fetch_lists(fetch), fuse) + f"""
SELECT query_id, 'bm25' AS retriever, CAST(rank AS BIGINT) AS rank, doc_id, round(bm25_score, 6) AS bm25_score,
       CAST(NULL AS DOUBLE) AS vector_score, CAST(NULL AS DOUBLE) AS rrf_score, CAST(NULL AS DOUBLE) AS linear_score
FROM bl WHERE rank <= {top_k}
UNION ALL
SELECT query_id, 'vector', CAST(rank AS BIGINT), doc_id, CAST(NULL AS DOUBLE), round(vector_score, 6),
       CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM vl WHERE rank <= {top_k}
UNION ALL
SELECT query_id, 'hybrid', CAST(rank AS BIGINT), doc_id, round(bm25_score, 6), round(vector_score, 6),
       round({hy_rrf}, 6), round({hy_lin}, 6)
FROM fz WHERE rank <= {top_k}"""


ORACLE["hybrid_rrf"] = hybrid_sql(TOP_K)
ORACLE["hybrid_fetch_k"] = hybrid_sql(3)
ORACLE["hybrid_linear"] = hybrid_sql(4, "linear", LINEAR_ALPHA)

ORACLE["vector_search_fields"] = _with(QS, TFIDF_INDEX, TFIDF_QUERY, TFIDF_RANKED) + f"""
SELECT r.query_id, CAST(r.rank AS BIGINT) AS rank, r.doc_id, round(r.vector_score, 6) AS vector_score,
       d.lang, d.source, d.n_chars
FROM vranked r JOIN documents d USING (doc_id) WHERE r.rank <= {TOP_K}"""

ORACLE["hybrid_fields"] = f"""
SELECT h.query_id, length(b.text) AS query_chars, h.retriever, h.rank, h.doc_id, d.lang, d.source, d.n_chars,
       length(d.text) AS text_chars
FROM (""" + hybrid_sql(TOP_K) + """) h JOIN documents d USING (doc_id) JOIN benchmark b ON b.item_id = h.query_id"""

# the callable encoder of the workload: shares of five vowels
_SHARES = ", ".join(f"CAST(length(lower(text)) - length(replace(lower(text), '{v}', '')) AS DOUBLE) / greatest(length(text), 1)"
                    for v in "aeiou")
ORACLE["encoder_callable"] = f"""
WITH dv AS (SELECT doc_id, [{_SHARES}] AS v FROM (SELECT doc_id, '. ' || text AS text FROM documents)),
qv AS (SELECT item_id, [{_SHARES}] AS v FROM benchmark),
du AS (SELECT doc_id, list_transform(v, lambda x: CASE WHEN list_dot_product(v, v) > 0 THEN x / sqrt(list_dot_product(v, v)) ELSE {d(0)} END) AS u FROM dv),
qu AS (SELECT item_id, list_transform(v, lambda x: CASE WHEN list_dot_product(v, v) > 0 THEN x / sqrt(list_dot_product(v, v)) ELSE {d(0)} END) AS u FROM qv)
SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, round(s, 6) AS vector_score
FROM (SELECT item_id AS query_id, doc_id, list_dot_product(qu.u, du.u) AS s,
             row_number() OVER (PARTITION BY item_id ORDER BY round(list_dot_product(qu.u, du.u), 9) + {d(0)} DESC, doc_id DESC) AS rank
      FROM qu CROSS JOIN du) WHERE rank <= {TOP_K}"""

# --------------------------------------------------------------------------- evaluation
QRELS = """
qrels AS (SELECT DISTINCT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
nrel AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY query_id)"""


def per_query_sql(results_cte: str, k: int = TOP_K) -> str:
    return f"""
hits AS (SELECT r.retriever, r.query_id,
                sum(CASE WHEN r.rank <= {k} AND q.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS hits,
                min(CASE WHEN q.doc_id IS NOT NULL THEN r.rank END) AS first_rel
         FROM {results_cte} r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id
         WHERE r.query_id IN (SELECT query_id FROM qs) GROUP BY ALL),
pq AS (SELECT retriever, h.query_id, hits / {d(k)} AS precision,
              CASE WHEN coalesce(n_rel, 0) > 0 THEN hits / CAST(n_rel AS DOUBLE) ELSE {d(0)} END AS recall,
              coalesce({d(1)} / first_rel, {d(0)}) AS reciprocal_rank,
              CASE WHEN hits > 0 THEN {d(1)} ELSE {d(0)} END AS hit_rate
       FROM hits h LEFT JOIN nrel USING (query_id)),
metrics AS (SELECT retriever,
                   round(sum(precision) / (SELECT count(DISTINCT query_id) FROM qs), 4) AS "Precision@{k}",
                   round(sum(recall) / (SELECT count(DISTINCT query_id) FROM qs), 4) AS "Recall@{k}",
                   round(sum(reciprocal_rank) / (SELECT count(DISTINCT query_id) FROM qs), 4) AS "MRR",
                   round(sum(hit_rate) / (SELECT count(DISTINCT query_id) FROM qs), 4) AS "HitRate@{k}",
                   (SELECT count(DISTINCT query_id) FROM qs) AS num_queries
            FROM pq GROUP BY retriever)"""


BM25_RES = f"res AS (SELECT 'BM25' AS retriever, query_id, rank, doc_id FROM branked WHERE rank <= {TOP_K})"
EVAL_BM25 = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked(), QRELS, BM25_RES, per_query_sql("res"))
for _key, _col in (("precision_at_k", "precision"), ("recall_at_k", "recall"), ("reciprocal_rank", "reciprocal_rank"),
                   ("hit_rate_at_k", "hit_rate")):
    ORACLE[_key] = EVAL_BM25 + f"\nSELECT query_id, round({_col}, 6) AS {_col} FROM pq"
ORACLE["encoder_batches"] = ORACLE["encoder_callable"]

ORACLE["evaluate_retriever"] = EVAL_BM25 + "\nSELECT * FROM metrics"

_CMP = _with(*BASE, fetch_lists(FETCH_K), rrf_sql([("bl", "bm25_score"), ("vl", "vector_score")], "fz"), QRELS,
             f"""res AS (SELECT 'BM25' AS retriever, query_id, rank, doc_id FROM bl WHERE rank <= {TOP_K}
    UNION ALL SELECT 'Vector', query_id, rank, doc_id FROM vl WHERE rank <= {TOP_K}
    UNION ALL SELECT 'Hybrid', query_id, rank, doc_id FROM fz WHERE rank <= {TOP_K})""", per_query_sql("res"))
ORACLE["compare_retrievers"] = _CMP + "\nSELECT * FROM metrics"
ORACLE["comparison_table"] = _CMP + f"""
SELECT retriever AS "Retriever", printf('%.4f', "Precision@{TOP_K}") AS "Precision@{TOP_K}",
       printf('%.4f', "Recall@{TOP_K}") AS "Recall@{TOP_K}", printf('%.4f', "MRR") AS "MRR",
       printf('%.4f', "HitRate@{TOP_K}") AS "HitRate@{TOP_K}"
FROM metrics"""

ORACLE["evaluate_empty"] = EVAL_BM25 + f"""
SELECT * FROM metrics UNION ALL
SELECT 'Silent', {d(0)}, {d(0)}, {d(0)}, {d(0)}, (SELECT count(DISTINCT query_id) FROM qs)"""

# --------------------------------------------------------------------------- reports
ORACLE["result_lines"] = f"""
SELECT query_id, retriever, rank,
       printf('[%d] %-20s | %s | %s', rank,
              CASE WHEN linear_score IS NOT NULL THEN printf('Lin=%.3f', linear_score)
                   WHEN rrf_score IS NOT NULL THEN printf('RRF=%.6f', rrf_score)
                   WHEN vector_score IS NOT NULL THEN printf('Vec=%.3f', vector_score)
                   WHEN bm25_score IS NOT NULL THEN printf('BM25=%.3f', bm25_score) ELSE '' END,
              CAST(doc_id AS VARCHAR), '') AS line
FROM (""" + hybrid_sql(TOP_K).replace("round(bm25_score, 6)", "bm25_score").replace(
    "round(vector_score, 6)", "vector_score") + ")"

ORACLE["result_lines_titled"] = f"""
SELECT l.query_id, l.retriever, l.rank, l.line || d.lang AS line
FROM (SELECT query_id, retriever, rank, doc_id,
       printf('[%d] %-20s | %s | ', rank,
              CASE WHEN rrf_score IS NOT NULL THEN printf('RRF=%.6f', rrf_score)
                   WHEN vector_score IS NOT NULL THEN printf('Vec=%.3f', vector_score)
                   ELSE printf('BM25=%.3f', bm25_score) END, CAST(doc_id AS VARCHAR)) AS line
      FROM (""" + hybrid_sql(TOP_K).replace("round(bm25_score, 6)", "bm25_score").replace(
    "round(vector_score, 6)", "vector_score") + ")) l JOIN documents d USING (doc_id)"

ORACLE["explain_bars"] = _with(QS, BM25_INDEX, BM25_QUERY, bm25_ranked(), _EXPLAIN_PAIRS) + f"""
SELECT query_id, doc_id, term, round(contribution, 6) AS contribution,
       repeat('█', greatest(CASE WHEN mx <> 0 THEN CAST(trunc(round(contribution * {d(40)} / mx, 9)) AS INTEGER)
                                 ELSE 0 END, 0)) AS bar,
       CAST(row_number() OVER (PARTITION BY query_id, doc_id
                               ORDER BY round(contribution, 9) + {d(0)} DESC, term ASC) AS BIGINT) AS position
FROM (SELECT *, max(contribution) OVER (PARTITION BY query_id, doc_id) AS mx FROM pcontrib)"""

ORACLE["index_stats"] = _with(BM25_INDEX, TFIDF_INDEX) + """
SELECT CAST(n_docs AS BIGINT) AS n_docs, round(avgdl, 6) AS avgdl,
       (SELECT count(*) FROM bterms) AS bm25_terms, (SELECT count(*) FROM bpost) AS bm25_postings,
       (SELECT count(*) FROM vvocab) AS tfidf_features
FROM bstats"""

# --------------------------------------------------------------------------- LSA: invariants
# 128 dimensions; unit rows for whatever has an in-vocabulary term, else zero rows
ORACLE["lsa_embeddings"] = _with(TFIDF_INDEX) + f"""
SELECT doc_id, CAST(128 AS BIGINT) AS dims,
       CASE WHEN doc_id IN (SELECT doc_id FROM vw) THEN {d(1)} ELSE {d(0)} END AS norm FROM documents"""
ORACLE["lsa_encode_query"] = _with(QS, TFIDF_INDEX, TFIDF_QUERY) + f"""
SELECT query_id, CAST(128 AS BIGINT) AS dims,
       CASE WHEN query_id IN (SELECT query_id FROM qwv) THEN {d(1)} ELSE {d(0)} END AS norm FROM qs"""
_LIST = (f"CAST({TOP_K} AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS first_rank, CAST({TOP_K} AS BIGINT) AS last_rank, "
         f"CAST({TOP_K} AS BIGINT) AS n_docs")
ORACLE["lsa_search"] = _with(QS) + f"\nSELECT query_id, {_LIST} FROM qs"
ORACLE["hybrid_lsa"] = _with(QS) + f"""
SELECT query_id, retriever, {_LIST} FROM qs CROSS JOIN (VALUES ('bm25'), ('vector'), ('hybrid')) r(retriever)"""
ORACLE["lsa_variance"] = _with(TFIDF_INDEX, """
lsums AS (SELECT term, sum(weight) AS s1, sum(weight * weight) AS s2 FROM vweights GROUP BY term),
ln AS (SELECT count(*) AS n FROM documents)""") + f"""
SELECT CAST(128 AS BIGINT) AS n_components, true AS is_share, true AS is_ratio,
       round(sum(s2) / any_value(n) - sum(s1 * s1) / (any_value(n) * any_value(n)), 6) AS total_variance FROM lsums, ln"""
ORACLE["lsa_components"] = f"SELECT {d(0)} AS max_gap, {d(0)} AS max_off"
ORACLE["lsa_index_stats"] = """
SELECT count(*) AS n_docs, count(*) AS embedding_rows, CAST(128 AS BIGINT) AS embedding_dims, true AS is_share FROM documents"""
