"""Operators of a training-data pipeline over text, web pages, tokens and vectors."""
