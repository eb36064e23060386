"""Civic open-data marts, quality checks, reports and a delay-risk model as Spark DataFrame plans."""
