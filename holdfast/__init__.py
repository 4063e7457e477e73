"""Account-churn pipeline for Spark: clean, encode, split, fit, evaluate, score."""
