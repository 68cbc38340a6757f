"""Order analytics on Spark: adaptive look-backs, variety, promotions, percentiles."""
