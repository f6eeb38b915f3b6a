"""kestrel: review analytics and model evaluation as Spark DataFrame jobs.

Every public operator takes and returns :class:`pyspark.sql.DataFrame` objects and
leaves physical planning to Catalyst and adaptive query execution.
"""

__version__ = "0.1.0"
