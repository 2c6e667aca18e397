"""Training-data operators: mixing, de-duplication, search, packing, classification, token output.

Every operator is a ``DataFrame -> DataFrame`` function; ``strata.llm.queries`` holds the thin
``opN_*`` entries over the driver tables. Nothing outside this folder imports it.
"""
