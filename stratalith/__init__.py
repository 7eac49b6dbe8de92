"""Spark-native data-integrity, lineage and history analytics over DataFrames."""
