"""DataFrame operators: quality, keys, repair, language, sentiment, categories."""
