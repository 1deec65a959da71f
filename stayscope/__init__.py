"""stayscope: time-anchored cohorts, sparse feature matrices and risk models on Spark.

Every operator takes and returns DataFrames, so Catalyst plans the work and a
caller decides where results are written.
"""

__version__ = "0.1.0"
