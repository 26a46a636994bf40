"""Wholesale-price tables on Spark: pages to typed rows, upserts, coverage, alerts and prices."""
