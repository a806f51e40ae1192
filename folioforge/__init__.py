"""Scanned-document analytics on Spark: pages and text lines as DataFrames, from image scan to scored text."""
