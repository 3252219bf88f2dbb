"""Flight-delay analytics on Spark: bronze, silver, gold and model stages."""
