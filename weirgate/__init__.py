"""A Spark-native engine for batch admission, facts and state."""
