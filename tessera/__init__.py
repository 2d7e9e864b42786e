"""tessera: user-profile, identity-graph, signal and text analytics as Spark
DataFrame / Structured Streaming operators.

Modules
-------
session            session defaults, shared checkpoint folder, ``cut_lineage``
functions          column helpers (strings, dates, math, arrays, maps, geohash, tokeniser,
                   map-valued aggregates, SQL-registered functions)
operators          profile, graph, timeseries, search, stats, frames, ml
sources            readers, sinks and table maintenance
streaming          tumbling-window word count and log-record streams
plans              the registered queries over the driver tables with their oracle SQL
jobs               spark-submit entry points with argument validation
"""

__version__ = "0.1.0"
