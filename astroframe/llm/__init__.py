"""Training-data operators for large text corpora, and their registered queries."""
