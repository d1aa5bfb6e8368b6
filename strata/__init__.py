"""strata — a spec-driven PySpark library for layered (bronze / silver / gold) sales data.

Every operator is a pure ``DataFrame -> DataFrame`` function built from Catalyst
built-ins; IO lives only in :mod:`strata.sources`, composite pipelines in
:mod:`strata.plans`.
"""

__all__ = ["functions", "operators", "plans", "sources", "specs", "schemas"]
