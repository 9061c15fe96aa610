"""Daily online-shop analytics as Spark jobs.

Layers, lowest first:

* ``functions``  - Column expressions (text, money, lookups, ages).
* ``operators``  - DataFrame building blocks (first-per-key, exact median, ranks, batches, rules).
* ``sources``    - CSV scan, Parquet tables with idempotent writes, landing folders, relational scan.
* ``plans``      - the shop's own queries: ingest, staging, models, data tests and the daily job.
"""

from merchmill.config import ShopConfig

__all__ = ["ShopConfig"]
