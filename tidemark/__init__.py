"""tidemark: historised warehouse tables on Spark.

``plans``      slowly-changing-dimension (type 2) deltas and the warehouse specs
``operators``  DataFrame -> DataFrame reshaping, set and quality operators
``functions``  Column helpers with one fixed meaning for dates, text, URLs, ...
``sources``    relation discovery, typed CSV, keyed sinks, period loader
``streaming``  the SCD2 delta applied to micro-batches
``jobs``       the registered queries on the test tables, with their SQL oracles
"""
