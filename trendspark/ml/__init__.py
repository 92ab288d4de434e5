"""Models, model search and evaluation on Spark ML."""
