"""Batch analysis of sports-squad snapshots on Spark, in bronze, silver and gold layers.

``functions``  Column -> Column rules (cleaning, banding, statistics, paths)
``operators``  DataFrame -> DataFrame building blocks, parameterised by column names
``sources``    schemas, readers and writers
``plans``      the three layers, put together from the parts above
"""

__version__ = "0.1.0"
