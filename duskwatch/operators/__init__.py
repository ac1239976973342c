"""Relational building blocks: parsing, enrichment, detectors and chains."""
