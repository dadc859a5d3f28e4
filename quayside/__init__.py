"""Warehouse-load operators on Spark DataFrames.

``functions``  column expressions (dates, text, labels)
``operators``  DataFrame -> DataFrame building blocks (projection, joins, numbering,
               slice comparison, dimension versions, table versions, run log)
``sources``    readers and writers for JDBC, files and tables
``plans``      the loads and reports put together from them
"""
