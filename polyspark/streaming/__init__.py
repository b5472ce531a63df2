"""None of the operators is a stream of its own.

Those that work row by row (``prompts.render``, ``prompts.choice_requests``,
``scoring.score_dummy``, ``doc_metrics.perplexity_parts``) take a streaming
DataFrame as they are; ``tests/test_streaming.py`` runs them on one.
"""
