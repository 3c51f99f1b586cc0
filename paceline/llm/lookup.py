"""Joins against unique keys that may own a large share of all rows, as the engine has them."""

from paceline.operators.skew import heavy_limit, looked_up

__all__ = ["heavy_limit", "looked_up"]
