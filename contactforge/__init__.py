"""Spark-native building blocks for molecular-interface tables.

``functions``  column expressions and per-sequence vectors
``operators``  DataFrame-to-DataFrame operators
``sources``    readers; ``plans`` end-to-end tables and sinks
``streaming``  incremental state; ``catalog`` the registered queries
"""
