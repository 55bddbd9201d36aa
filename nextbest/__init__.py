"""nextbest: next-product ranking as PySpark DataFrame operators.

Subpackages
-----------
sources    readers and writers (CSV snapshots, line records, ranked lists, test tables)
functions  scalar Column expressions (coercion, dates, code maps)
operators  DataFrame -> DataFrame operators (cleaning, encoding, features,
           naive-Bayes fit/score, candidate filtering, top-k, evaluation)
plans      composed jobs (time-split stand-in on the test tables, full pipeline,
           the query registry used by ``__spark_entry__``)
streaming  micro-batch scoring of a snapshot stream with a fitted model
"""

__version__ = "0.1.0"
