"""Operators of a training-data pipeline over documents, pages, embeddings and conversations.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` has one entry per
operator, ``oracles.ORACLES`` its DuckDB SQL where SQL can say it.
"""
