"""Operators of a training-data pipeline over text documents and pages.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only when it can be imported.
"""
