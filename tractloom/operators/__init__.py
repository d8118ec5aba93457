"""DataFrame operators of the market-geography engine."""
