import string

from pyspark.sql import functions as F

from rankspan.functions.text import bm25_tokens, vector_terms, word_ngrams, word_tokens
from rankspan.functions.stopwords import ENGLISH_STOP_WORDS


def py_bm25_tokens(text):
    text = text.lower().translate(str.maketrans("", "", string.punctuation))
    return [t for t in text.split() if len(t) > 1]


SAMPLES = ["The ferry leaves the north pier at nine, and the ferry returns at noon.",
           "top-k O(1) snake_case a b  x y z\ttab\nnew",
           "Ferry fares are low in the off-season; the harbor office sells passes.",
           "Übergrößenträger dürfen nicht ß.  Él está aquí: ¿qué?",
           "", "  ", "a"]


def test_bm25_tokens_match_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    got = [r[0] for r in df.select(bm25_tokens("t")).collect()]
    assert got == [py_bm25_tokens(s) for s in SAMPLES]


def test_punctuation_is_deleted_not_split(spark):
    row = spark.range(1).select(bm25_tokens(F.lit("off-season O(1) snake_case"))).first()[0]
    assert row == ["offseason", "o1", "snakecase"]


def test_vector_tokens_and_ngrams(spark):
    row = spark.range(1).select(word_tokens(F.lit("The off-season: harbor_x 12 a Öl"))).first()[0]
    assert row == ["the", "off", "season", "harbor_x", "12", "öl"]
    terms = spark.range(1).select(vector_terms(F.lit("Ferry fares are low in the off-season"))).first()[0]
    # stop words removed before bigrams: bigrams jump over them
    assert terms == ["ferry", "fares", "low", "season", "ferry fares", "fares low", "low season"]


def test_ngram_edges(spark):
    df = spark.createDataFrame([([],), (["x"],), (["a", "b", "c"],)], "w array<string>")
    got = [r[0] for r in df.select(word_ngrams(F.col("w"), (1, 3))).collect()]
    assert got == [[], ["x"], ["a", "b", "c", "a b", "b c", "a b c"]]


def test_stop_word_list():
    assert len(ENGLISH_STOP_WORDS) == 318
    assert "the" in ENGLISH_STOP_WORDS and "off" in ENGLISH_STOP_WORDS
