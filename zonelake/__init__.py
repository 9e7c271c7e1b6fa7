"""zonelake: a PySpark-native batch lakehouse for city-style open data.

Raw files are loaded into typed tables, cleaned by declarative specs, checked by
observe-only quality rules, enriched, loaded into a star schema and answered by
DataFrame/SQL reports, with governance kept as tables.  Every operator takes its
columns as parameters and runs on Spark built-in expressions.
"""

__version__ = "0.1.0"
