"""Bronze / silver / gold batch pipelines as reusable Spark DataFrame operators.

Layout
------
``functions``  Column -> Column helpers (tolerant casts, text, dates)
``operators``  DataFrame -> DataFrame steps (rules, de-duplication, lookups, reports)
``sources``    CSV landing, layer and catalog readers
``sinks``      layer writers and catalog publication
``plans``      the bronze, silver and gold datasets and the end-to-end run
"""

__version__ = "0.1.0"
