"""skyloom: sky-survey catalogue analytics and data-quality operators on Spark DataFrames."""
