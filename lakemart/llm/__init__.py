"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; its queries are added by
``__spark_entry__.py`` when it can be imported.
"""
