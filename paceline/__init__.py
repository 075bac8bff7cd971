"""Entity-history features and two-stage forecasting on Spark DataFrames."""
