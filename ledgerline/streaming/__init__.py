"""Streaming: intentionally empty.

The reports are batch SELECTs over snapshot tables; the reference has no
streaming operator is built.  Re-running a report for new snapshot dates is
a batch job (``plans.runner``) whose sink overwrites only the written date
partitions.
"""
