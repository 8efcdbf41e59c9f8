"""Assay-design analytics and training-data operators on PySpark DataFrames."""
