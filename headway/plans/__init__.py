"""Whole pipelines: from feed tables to the products, the manifest and the run outcomes."""
