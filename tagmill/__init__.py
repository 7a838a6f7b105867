"""Audience labelling and table loading on Spark.

Everything here is a function from DataFrame to DataFrame (or a sink that ends
one), built from Spark's own expressions.  No user data passes the driver: only
rule maps, dictionaries and column lists do, each behind a size check.
"""
