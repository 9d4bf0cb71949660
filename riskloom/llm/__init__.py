"""Training-data operators: scoring, de-duplication, personal data, toxicity, archives, licences, packing.

Nothing outside this package imports it, except the guarded registration in ``__spark_entry__.py``.
"""
