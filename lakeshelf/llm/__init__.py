"""Operators of a training-data pipeline: deduplication, cleaning, mixing, packing, serialisation.

Nothing outside this subpackage imports it, except the driver contract (``__spark_entry__``) and
``corpus_pipeline``, which belongs to it.
"""
