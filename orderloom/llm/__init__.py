"""Operators of a training-data pipeline; see `queries` for one query per operator."""
