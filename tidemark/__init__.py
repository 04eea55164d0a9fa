"""Analytics on large archives of nested posts, written as plain Spark DataFrame jobs.

Sub-packages
------------
``sources``    reading, schema work, shaping, writing
``functions``  column expressions and the fixed word lists and patterns
``operators``  profiling, filters, post reports, chart data
``ml``         features, clustering, classification, regression, anomalies, metrics
``plans``      the test-table adapter and the registry of checked queries
"""
