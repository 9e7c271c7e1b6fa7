"""Generic operators: every column name is a parameter, every step a Spark plan."""
