"""Engineering-asset analytics on Spark: DataFrame and SQL operators with defined null, rounding and tie rules."""
