"""Training-data operators: language ID, near-duplicates, secrets, personal
data, WARC, decontamination, packing and quality. Nothing else in the library
imports this subpackage."""
