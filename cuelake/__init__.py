"""cuelake: Spark operators for text-classification data at lake scale.

Layers
------
functions   Column -> Column building blocks (redaction, keys, hashed draws, scoring)
sources     scans and sinks (JSONL, small objects, manifests, metrics, head tables)
operators   DataFrame -> DataFrame jobs (curation, ingest, augmentation, metrics, fits)
streaming   Structured Streaming forms of capture, ingest and monitoring
plans       the operators applied to the driver tables, with their SQL counterparts
"""

from cuelake.session import build_session

__all__ = ["build_session"]
