"""Spark jobs for multilingual corpus preparation and few-shot evaluation.

Language, task and template are columns, so one job covers all of them.
"""
