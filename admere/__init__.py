"""admere: a Spark-native marketing analytics pipeline.

Every operator is a lazy ``DataFrame -> DataFrame`` function. Catalyst plans the
work; this package only declares it.
"""

__version__ = "0.1.0"
