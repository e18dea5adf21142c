"""Spark operators and pipelines for genotype, carrier and cohort tables."""
