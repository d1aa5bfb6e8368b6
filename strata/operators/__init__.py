"""Generic DataFrame -> DataFrame operators (profiling, cleaning, enrichment, metrics, DQ)."""
