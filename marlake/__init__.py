"""marlake: a Spark-native marketplace lakehouse and analytics library."""
