"""ledgerloom — SaaS operations analytics as Spark jobs.

Layers (each a plain function of DataFrames, so Catalyst sees one plan):

* ``sources``      driver tables → raw tables, CSV / JSON landing loaders
* ``functions``    column helpers (variant casts, exact ratios)
* ``operators``    staging, intermediate, marts, data-quality checks, metrics
* ``plans``        model registry, namespaces, the fail-closed pipeline
* ``streaming``    idempotent incremental file loads (availableNow)
"""

__all__ = ["session"]
