"""Training-data operators: quality rules, tokenizing, scoring, de-duplication,
decontamination, sharding and extraction.  Nothing else in the library imports
this subpackage."""
