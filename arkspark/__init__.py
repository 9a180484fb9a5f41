"""Web-archive capture analytics and training-data operators on Spark DataFrames."""
