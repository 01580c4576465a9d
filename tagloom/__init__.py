"""tagloom: user-profile tagging and item recommendation as Spark DataFrame jobs.

Layout
------
sources/    table loaders, fixture adapters, profile snapshots, sinks
functions/  Column builders: tag code book, age, time slots, JSON
operators/  DataFrame -> DataFrame operators (interest merge, slots,
            similarity, push, profile upsert, range enrichment)
plans/      the registered queries and their DuckDB oracle SQL
streaming/  a Structured Streaming driver for the daily jobs
"""

__version__ = "0.1.0"
