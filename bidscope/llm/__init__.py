"""Training-data operators: thirteen corpus operators and their queries (see ``registry``).

Nothing outside this package imports it except the guarded hook in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
