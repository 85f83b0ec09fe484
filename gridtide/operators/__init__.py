"""DataFrame in, DataFrame out; every operator stays lazy."""
