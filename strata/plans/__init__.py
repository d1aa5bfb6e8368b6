"""Composite pipelines (silver cleaning, gold enrichment, dashboard, audit) built from operators."""
