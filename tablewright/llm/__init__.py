"""Operators of a training-data pipeline: tokens, near duplicates, quality, licences, URLs, archives, chat.

Nothing outside this subpackage imports it. ``queries.py`` registers one query per operator.
"""
