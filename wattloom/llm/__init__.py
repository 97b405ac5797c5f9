"""Operators of a training-data pipeline; the rest of the library does not use them."""
