"""Operators of a training-data pipeline over `documents` and its companions. Nothing else in the package imports this."""
