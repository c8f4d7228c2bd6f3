"""Raster-to-feature-table analytics as Spark DataFrame operators."""
