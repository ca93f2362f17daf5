"""Operations of a training-data pipeline: search, deduplication, extraction,
classification, redaction, license scanning and tokenization, as Spark jobs."""
