"""Training-data operators: one module per operator, each with its driver query.

Every module holds an operator with a general interface, the thin
``opN_<name>`` query over the whole ``documents`` table and, where SQL can
express the rows, its DuckDB text.  ``catalogue`` gathers the queries.
Nothing else in the library imports this package.
"""
