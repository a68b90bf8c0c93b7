"""DataFrame -> DataFrame operators of the price mart."""
