"""Record curation and analytics operators for Spark DataFrames."""
