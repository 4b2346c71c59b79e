"""DataFrame -> DataFrame operators."""

from tallyframe.operators import clean, compare, joins, rank, rates, shape

__all__ = ["clean", "compare", "joins", "rank", "rates", "shape"]
