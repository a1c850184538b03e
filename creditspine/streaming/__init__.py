"""Nothing lives here on purpose.

The workload is a monthly batch: the unit of increment is one snapshot month,
written idempotently by :func:`creditspine.sources.snapshots.write_snapshot`.
"""
