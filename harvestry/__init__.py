"""harvestry: a Spark-native engine that turns loosely structured sources into curated collections."""
