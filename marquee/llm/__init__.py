"""Operators that prepare a text corpus for model training.

Every module holds one operator; ``queries`` applies each to its whole table. Nothing outside
this package imports it.
"""
