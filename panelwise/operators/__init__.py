"""DataFrame in, DataFrame out. Panels hold one row per (keys, order)."""
