"""Three-layer e-commerce table pipeline on plain PySpark DataFrames."""
