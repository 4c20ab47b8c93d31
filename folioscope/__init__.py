"""folioscope: disclosure analytics and corpus preparation on Spark DataFrames.

Layout: ``sources`` (readers and sinks), ``functions`` (Column -> Column),
``operators`` (DataFrame -> DataFrame), ``plans`` (the registered queries),
``streaming`` (Structured Streaming variants).  The optional subpackage ``llm``
holds the corpus operators; nothing outside it imports it.
"""
