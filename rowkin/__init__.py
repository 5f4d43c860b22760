"""rowkin: record linkage on PySpark DataFrames."""
