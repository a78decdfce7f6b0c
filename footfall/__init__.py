"""User-behaviour analytics on Spark DataFrames.

Layout
------
``sources``    reading and writing logs, samples and the keyed user table
``operators``  cleaning, features, upsert, cells, distributions
``functions``  column expressions shared by the operators
``plans``      feature queries, summaries, profiles, figure tables
``streaming``  landing a stream of log lines in time-bucketed files
``jobs``       command-line entry points
"""
