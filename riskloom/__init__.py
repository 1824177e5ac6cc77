"""riskloom: credit-risk data operators on Spark DataFrames.

Subpackages: ``sources`` (tables, views, files, policy config), ``functions`` (Column
expressions), ``operators`` (ETL, ranks, metrics, drift, weights, splits, features, contract,
governance), ``plans`` (registered queries with their SQL oracles, models, I/O round trips),
``streaming`` (audit log). See README.md.
"""

__version__ = "0.1.0"
