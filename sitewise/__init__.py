"""Spark-native analytics for cohort tables of site counts."""
