"""Training-data operators.  Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it; ``__spark_entry__.py`` adds its queries
only when it can be imported."""
