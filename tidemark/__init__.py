"""Multi-tenant commerce analytics as plain functions over Spark DataFrames."""
