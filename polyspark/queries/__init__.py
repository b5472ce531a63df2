"""Registered queries over the given tables, each with its SQL where one exists.

A module lists ``QUERIES``: name -> (function of session and data folder, SQL or None).
"""

from polyspark.queries import aggregates, corpus, doc_metrics, evaluation, prompts, reports, scoring, vocabulary

MODULES = (corpus, vocabulary, prompts, scoring, doc_metrics, aggregates, evaluation, reports)
QUERIES = {name: pair for module in MODULES for name, pair in module.QUERIES.items()}
