"""Table operators: schema conformance, data quality, privacy, deduplication and loading."""
