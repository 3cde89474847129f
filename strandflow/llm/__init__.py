"""Training-data operators: tokens, packing, near duplicates, repeats, classifiers, neighbours."""
