"""Training-data operators: near-duplicate search, classifiers, packing, redaction and tokenizing over document tables.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
