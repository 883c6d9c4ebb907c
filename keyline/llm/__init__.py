"""Training-data pipeline operators: language id, near and exact duplicates, source
mixing, licence scan, token counts, toxicity, decontamination, WARC and PII."""
