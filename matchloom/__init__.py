"""A Spark-native engine for entity resolution and enrichment."""
