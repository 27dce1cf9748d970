"""playlake: a PySpark-native medallion lakehouse library.

Every public function takes and returns DataFrames or Columns; nothing is
collected inside a transformation, and Catalyst sees one declarative plan.
"""

__version__ = "0.1.0"
