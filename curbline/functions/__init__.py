"""Spark-native operators for sensor, transit, collision and street-network tables."""
