from .stopwords import ENGLISH_STOP_WORDS
from .text import (bm25_document_text, bm25_tokens, remove_stop_words, vector_document_text, vector_terms, vector_words,
                   word_ngrams, word_tokens)
from .vector import l2_norm, l2_normalize

__all__ = ["ENGLISH_STOP_WORDS", "bm25_document_text", "bm25_tokens", "remove_stop_words", "vector_document_text",
           "vector_terms", "vector_words", "word_ngrams", "word_tokens", "l2_norm", "l2_normalize"]
