"""Training-data operators: secret scan, byte-level BPE, revisit resolution, importance resampling, URL rules,
line chunks, benchmark templates, class-conditional language models, n-gram joins and vector search.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
