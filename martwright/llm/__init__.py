"""Training-data operators: packing, deduplication, classifiers, tokens, decontamination."""
