"""Training-data operators for large text corpora.

Nothing outside this package imports it. Each module holds one operator with
its own interface; ``queries`` binds them to the driver tables.
"""
