"""Operators of a training-data pipeline: packing, byte-level BPE, line dedup,
quality rules, license scan, SimHash near-dedup, language ID, URL filters,
embedding near-dedup and toxicity.  Nothing else in the library imports this."""
