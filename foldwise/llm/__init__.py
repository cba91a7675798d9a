"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; ``queries`` applies
them to the sample tables. Nothing outside this package imports it.
"""
