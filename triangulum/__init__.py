"""Spark-native insurance reserving and claims analytics.

Every operator takes DataFrames and returns a DataFrame; nothing keeps global
state.  Sub-packages: ``sources`` (readers, writers, generators), ``functions``
(column expressions), ``operators`` (relational and simulation operators),
``plans`` (operators composed into the end-to-end flows) and ``streaming``.
"""

__version__ = "0.1.0"
