"""Operators of a training-data pipeline: each is a DataFrame in, DataFrame out function.

Nothing outside this package imports it; ``registrar.llm.queries`` lists the registered queries.
"""
