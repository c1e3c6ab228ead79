"""Training-data operators: dedup, URL rules, fingerprints, scoring, mixing and tokenization.

Nothing outside this subpackage imports it (the registry in ``__spark_entry__.py``
adds its queries only when it can be imported).
"""
