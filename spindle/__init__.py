"""spindle: a Spark-native feature, clustering and classification engine.

Every operator maps a DataFrame to a DataFrame (fits return a model-sized
table next to the fitted object).  Work is expressed with built-in Spark
expressions so Catalyst can prune, push down and codegen it; MLlib is used
where an estimator is the feature itself.
"""

__version__ = "0.1.0"
