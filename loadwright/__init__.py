"""loadwright: governed file loads and tabular models on Spark DataFrames.

Sub-packages
------------
sources    text deliveries (delimited, fixed width), delivery names, CSV
functions  column-expression helpers (tokens, keys, names, rendering)
operators  rejects, key gates, load modes, transforms, counts
plans      load spec, versioned target store, run journal, governed load
models     least squares, logistic regression, random forest node tables
streaming  an incremental delivery watcher on Structured Streaming
"""

__version__ = "0.1.0"
