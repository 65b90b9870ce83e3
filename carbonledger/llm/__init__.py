"""Training-data pipeline operators on Spark DataFrames (language-model corpora)."""
