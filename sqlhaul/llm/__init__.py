"""Training-data operators: ten components of a corpus pipeline.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` has the thin registered
queries on top of them.
"""
