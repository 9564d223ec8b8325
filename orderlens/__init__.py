"""orderlens: customer analytics on Spark DataFrames.

Reads folders of transaction parquet, rolls them up per customer, profiles
columns and their associations, splits data exactly by class, selects
features, trains and evaluates pyspark.ml models and scores tables or
streams of records.
"""

__version__ = "0.1.0"
