"""Daily listing analytics as Spark DataFrame operators.

Every public function maps DataFrames (or Columns) to DataFrames (or Columns) with built-in Spark
functions only; nothing here runs Python code per row and nothing passes whole data through the driver.
"""
