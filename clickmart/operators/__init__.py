"""DataFrame operators: filters, joins, counts, exact ranks, top-k, shares, pair features."""

from . import aggregates, features, filters, joins, ordering, ranking, shares

__all__ = ["aggregates", "features", "filters", "joins", "ordering", "ranking", "shares"]
