"""Operators of a training-data pipeline over documents, conversations and embeddings.

Nothing outside this subpackage imports it. Each module holds one operator;
`queries` holds the registered queries and their DuckDB oracles.
"""
