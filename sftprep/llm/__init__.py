"""Training-data pipeline operators.

Each module holds one operator and its check query; ``queries`` lists them.
Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
