"""variantloom: annotated-variant analytics as plain Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns) and stays lazy
unless its docstring says that it runs a small check or writes a table.
Missing values are NULL everywhere; the "." placeholder appears only in exports.
"""

__version__ = "0.1.0"
