"""Retail medallion analytics as PySpark jobs: ingest, Silver, quality gate, star schema, marts, serving queries."""
