"""scriptorium: Spark operators for document-corpus ELT.

Every operator takes and returns DataFrames; only ``sinks`` and
``plans.ingest`` write. See README.md for the layout.
"""
