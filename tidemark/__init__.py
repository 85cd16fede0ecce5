"""tidemark: Spark-native sales ELT and analytics.

Layers (each a plain function returning a DataFrame, composed lazily so
Catalyst sees the whole plan):

* ``sources``    - landed CSV/JSON/binary file scans, test-table adapters
* ``functions``  - Column helpers (surrogate keys, null-strict greatest, ...)
* ``operators``  - staging, enrichment, fact upsert, dimensions, marts,
                   checks, usage analytics, serving queries
* ``sinks``      - landing writers, manifests, partitioned keyed fact table
* ``streaming``  - Structured Streaming ingest / dedup / upsert / KPI restate
* ``plans``      - end-to-end pipeline composition (``run_elt``)
"""

from tidemark.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
