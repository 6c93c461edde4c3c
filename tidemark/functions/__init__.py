"""Column-level functions: rules, buckets, dates, codecs, text."""
