"""tillroll: retail sales analytics as Spark DataFrame transformations.

Raw wide exports are cleaned, split into a star schema and answered by a fixed
catalogue of reports. Every public function maps DataFrames to DataFrames and
stays lazy, except where its docstring says that it writes a table.
"""
