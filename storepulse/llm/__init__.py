"""Operators of a training-data pipeline over document, page and embedding tables.

Nothing outside this package imports it; its queries are in ``queries``.
"""
