"""tidewater: commerce-event lakehouse analytics written as Spark DataFrame jobs.

Layers: landing JSON -> bronze (VARIANT) -> silver (typed, keyed) -> gold
(dimensions, facts, daily marts).  Every builder is a pure
``DataFrame -> DataFrame`` function, so the same code runs in batch and inside
a Structured Streaming ``foreachBatch``.
"""

__all__ = ["session"]
