"""Training-data operators: near-duplicates, packing, tokens, fingerprints, scans and classifiers.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
