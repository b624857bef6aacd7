"""priceflow: captured retail pages -> comparable price rows, on Spark.

``functions``  Column -> Column rules (text, price, quantity, labels)
``operators``  DataFrame -> DataFrame steps (cards, parsing, frontier, crawl log)
``sources``    inputs derived from the given tables, and the sink
``streaming``  the same transforms on a stream of snapshot files
``plans``      the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
