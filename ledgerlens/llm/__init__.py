"""Training-data operators: encoding, deduplication, extraction, privacy, decontamination,
language and quality, chat formatting and secret scans, each a Spark job over a whole table."""
