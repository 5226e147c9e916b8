"""Spark-native fund analytics: panels, regimes, scores, selections, text attributes and data quality as DataFrame jobs."""
