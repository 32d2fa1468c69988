"""Spark-native lakehouse for valuing property listings.

Packages
--------
functions  column expressions (parsing, geography, pages, calibration)
operators  DataFrame -> DataFrame operators (lookups, medians, spatial joins, merges, state)
sources    readers and snapshot writers
plans      the layer plans: clean, reference statistics, features, scoring, the whole lake
streaming  Structured Streaming entry points
catalog    the registered queries and the SQL each one must agree with
"""
