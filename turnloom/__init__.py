"""turnloom: chat exports and instruction files to training datasets, on Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and
builds a lazy logical plan; nothing is collected to the driver except bounded
scalars (counts, split thresholds, a vocabulary of a fixed maximum size).
"""

__version__ = "0.1.0"
