"""pulselake: a Spark-native lakehouse for wearable-device telemetry.

The package is layered the way the data moves:

``sources``    reading and writing exports, topic logs, lake tables and JDBC
``streaming``  the continuous topic -> Bronze landing query
``operators``  DataFrame -> DataFrame transformations
``functions``  Column -> Column expressions
``plans``      jobs that wire operators to stored tables
"""
