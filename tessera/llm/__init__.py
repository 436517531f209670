"""Operators for preparing language-model training data.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when it can be imported. One module per operator, ``queries`` holds the thin
``opN_*`` queries.
"""
