"""Training-data operators: scoring, filtering, search, de-duplication, tokens.

Nothing else in the library imports this package.  Each module holds one
operator with its own general interface; ``llm.queries`` registers the thin
queries over the provided tables.
"""
