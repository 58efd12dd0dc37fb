"""Operators for preparing language-model training text.

One module per operator; ``queries.py`` registers them.  Nothing outside this
subpackage imports it.
"""
