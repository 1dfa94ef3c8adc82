"""Credit-portfolio analytics on Spark: raw files to marts, features, scores."""
