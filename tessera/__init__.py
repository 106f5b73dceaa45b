"""Spark-native mash-up of descriptive and process records held by many sources."""
