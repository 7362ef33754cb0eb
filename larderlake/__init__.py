"""Retail lakehouse on open-source Spark: ingest, cleanse, version, model, aggregate, govern, audit."""
