"""Operators for training-data pipelines: language id, decontamination, page
extraction, near-duplicate joins, archives, secrets, toxicity, packing and
token counts.  Nothing else in the library imports this subpackage."""
