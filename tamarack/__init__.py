"""Review-text analytics and feature engineering on Spark DataFrames."""
