"""Gridloom: survey-raster analytics as Spark DataFrame plans."""
