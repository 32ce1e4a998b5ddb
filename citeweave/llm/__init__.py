"""Training-data operators: scoring, deduplication, mixing, counting and scanning of documents.

Nothing outside this subpackage imports it.  Each operator lives in a module of its
own; ``queries`` binds every operator to its whole intended table.
"""
