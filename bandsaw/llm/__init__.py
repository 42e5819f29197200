"""Operations of large training-data pipelines: URL filters, deduplication, language, tokens, archives, search."""
