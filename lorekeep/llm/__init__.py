"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  ``queries.py`` lists the
registered queries and their SQL; each other module holds one operator.
"""
