"""Stages keep the values of columns that are called like their helpers, tell
rows apart by id and text, and the entry point does without missing packages."""

import os
import subprocess
import sys
import unicodedata

import pytest
import regex
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from helpers import words  # noqa: E402

from rankspan.llm import bpe, decontamination, neardup, pii, toxicity  # noqa: E402
from rankspan.llm.queries import vocabulary_path  # noqa: E402

HELPERS = ("_t", "_base", "_cand", "_spans", "_row", "_lower_text", "_toxic_score", "_LOWER_TEXT_", "h1", "h2", "id", "words", "kid",
           "class_id", "none", "text_", "_given", "_told")


def clashing(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in HELPERS])


def kept_values(out, docs):
    assert out.columns == docs.columns
    for r in out.collect():
        assert [r[name] for name in HELPERS] == [f"{name} {r['doc_id']}" for name in HELPERS]


def test_redact_keeps_clashing_columns(spark):
    docs = clashing(spark, ["mail a@b.c now", "nothing here", None, ""])
    out = pii.redact(docs)
    kept_values(out, docs)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: "mail [EMAIL] now", 1: "nothing here", 2: None, 3: ""}


def test_decontamination_keeps_clashing_columns(spark):
    item = words(30, 5)
    docs = clashing(spark, [words(10, 1) + " " + item + " " + words(10, 2), words(40, 3), None])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontamination.drop_contaminated(docs, items)
    kept_values(out, docs)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2]


def test_toxicity_keeps_clashing_columns(spark):
    docs = clashing(spark, [words(20, 1), None])
    out = toxicity.keep_ordinary(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    kept_values(out, docs)
    assert out.count() == 2


def test_keep_one_keeps_clashing_columns(spark):
    docs = clashing(spark, [words(60, 1), words(60, 1), words(60, 2), None, ""])
    out = neardup.keep_one(docs)
    kept_values(out, docs)
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 3, 4]


def test_keep_one_on_shared_and_null_ids(spark):
    a, b, c = words(60, 1), words(60, 2), words(60, 3)
    near = a.split()
    near[30] = "changed"
    rows = [(1, a), (1, b), (2, " ".join(near)), (None, c), (None, c), (3, c.upper()), (4, b), (4, b), (None, words(60, 4)), (5, "")]
    rows += [(5, ""), (None, None)]
    out = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    # a stays under 1, the near copy goes; b under 1; c under 3 (ids come before none); the rest has no partner
    assert got == sorted([(1, a), (1, b), (3, c.upper()), (None, words(60, 4)), (5, ""), (5, ""), (None, None)], key=str)
    assert neardup.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bpe_code_points_equal_the_library():
    """Every code point between letters, between digits, alone and before a suffix
    (of uniform blocks - unassigned, private, ideographs, Hangul - each 64th)."""
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    with open(path, "rb") as f:
        codec = bpe.BpeCodec(f.read())
    letter = regex.compile(r"[\p{L}\p{N}]")

    def uniform(c):
        kind = unicodedata.category(chr(c))
        return kind == "Co" or kind == "Cn" and not letter.match(chr(c)) or 0x3400 <= c < 0xD7A4 or 0x17000 <= c < 0x18000 or 0x20000 <= c < 0x2A000

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c % 64 == 0 or not uniform(c))]
    wrong = []
    for lo in range(0, len(points), 20_000):
        part = points[lo:lo + 20_000]
        texts = [f"a{chr(c)}b 1{chr(c)}1 {chr(c)} {chr(c)}'s {chr(c)}{chr(c)}" for c in part]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        wrong += [hex(c) for c, w, g in zip(part, want, codec.encode(texts)) if w != g.tolist()]
    assert wrong == []


def test_entry_without_a_package():
    code = ("import sys; sys.modules['zstandard'] = None\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) >= 56 and set(e.queries()) >= set(e.oracle_sql()) and 'op5_toxicity' not in e.queries()")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
