"""Operations of a training-data pipeline: filters, deduplication, search, tokens and archives."""
