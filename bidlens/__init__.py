"""Spark-native analytics for ad impressions and mixed order-processing workloads.

Everything here is a function from DataFrame to DataFrame (or to a streaming
query). Sub-packages: ``sources`` read and decode, ``functions`` build column
expressions, ``operators`` reshape and write tables, ``streaming`` runs
continuous queries and ingestion, ``plans`` holds the named reports.
"""
