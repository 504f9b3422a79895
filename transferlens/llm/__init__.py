"""Operators that prepare text corpora for training language models.

Nothing outside this folder imports it. ``queries`` registers one query per operator.
"""
