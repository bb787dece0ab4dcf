"""Training-data operators: licences, URLs, token files, dedup, scoring."""
