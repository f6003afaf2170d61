"""Operators for preparing large text corpora for language-model training.

One module per operator; ``queries`` registers one query each. Nothing outside this subpackage
imports it, apart from the guarded registration in ``__spark_entry__``.
"""
