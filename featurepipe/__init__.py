"""featurepipe: Spark-native feature, training-set, scoring and drift operators.

Every public operator is a function from DataFrames to a DataFrame. Nothing is
collected to the driver except bounded scalars (counts, thresholds, bucket
edges); all row-level work stays in Spark jobs.
"""

__version__ = "0.1.0"
