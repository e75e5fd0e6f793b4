"""Training-data operators: sharding, decontamination, packing, secret scans,
similarity joins, training order, quality rules, language id, substring
de-duplication, url reputation, fill-in-middle, conversation repair and line
de-duplication.  Nothing outside this package imports it."""
