"""Training-data operators: quality rules, packing, archives, URL filters, near-duplicates, secrets, line dedup,
decontamination, token files and chat formatting. Nothing else in the library imports this subpackage."""
