"""riskloom: transaction risk scoring and star-schema history on Spark DataFrames."""
