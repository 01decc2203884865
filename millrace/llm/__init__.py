"""Training-data operators: tokenising, deduplication, decontamination, filters and scans."""
