"""murmur — public-opinion analytics on Spark DataFrames and Structured Streaming.

Raw documents (articles, posts, comment threads) are kept unparsed in a raw zone; Spark jobs route,
extract, deduplicate and normalise them into two warehouse tables (contents, comments), a two-tier
classifier labels comments, and DataFrame queries answer the serving questions (opinion lists,
sentiment shares, daily snapshots, trending and compared keywords, shift alerts).

Layout:
    sources/    table loading, raw-zone scans, source registry
    functions/  column-expression helpers (times, urls, hashing, json, html, text)
    operators/  DataFrame transforms: candidates, warehouse, extraction, sentiment, analytics, jobs
    plans/      the query catalogue (`queries()`) and its DuckDB oracle SQL
    streaming/  Structured Streaming twins of the batch operators
"""

import sys as _sys

__all__ = ["session", "fixtures"]

# Python workers need the few functions that run inside tasks (the HTML parser behind
# `mapInPandas`, the tier-2 pandas UDF). Pickling this package by value ships them inside the task
# closure, so executors do not need the package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be shipped (--py-files)
    pass
