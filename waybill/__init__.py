"""Parcel delivery analytics on Spark DataFrames."""
