"""Model fitting, evaluation and search on pyspark.ml."""
