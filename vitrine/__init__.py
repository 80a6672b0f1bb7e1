"""Vitrine: product-catalogue analytics as plain Spark DataFrame operators."""
