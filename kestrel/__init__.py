"""kestrel: DataFrame-first analytics on Spark.

Typed text/CSV ingestion, small relational SQL, feature preparation with
logistic regression and its evaluation, k-means (MLlib and an explicit Lloyd
loop), and a seeded Gaussian point source. Every function takes and returns
DataFrames; the work runs as Spark jobs.
"""

__version__ = "0.1.0"
