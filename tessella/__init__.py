"""Tessella: quantitative tissue and cell microscopy as PySpark DataFrames."""
