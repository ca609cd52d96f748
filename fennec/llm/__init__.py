"""Training-data operators: token stores, decontamination, language ID,
segmentation, pseudonyms, deduplication, HTML extraction, quality rules.
Nothing else in the package imports this subpackage."""
