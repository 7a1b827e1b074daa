"""chronoframe: Spark-native preparation, evaluation and ensembling of tabular and time-series tables.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``) built on Spark SQL
expressions, windows, joins and ``pyspark.ml``; nothing row-shaped passes through the driver.
"""

__version__ = "0.1.0"
