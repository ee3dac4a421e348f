"""Training-data operators: deduplication, extraction, quality, decontamination,
archives, licenses, sharding and packing. Nothing outside this subpackage imports it."""
