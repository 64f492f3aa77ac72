"""ratelake: rating logs and product catalogs as Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame.  ``functions``
holds column expressions, ``operators`` the relational operators, ``sources``
the readers and writers, ``streaming`` the incremental ingest, and ``plans``
the batch jobs and the registered queries.
"""

__version__ = "0.1.0"
