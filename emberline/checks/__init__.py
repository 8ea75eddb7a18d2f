"""Operator checks on the benchmark tables: a Spark query and, where SQL can say it, its oracle."""
