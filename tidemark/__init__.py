"""tidemark: entity-by-period panel analytics on Spark DataFrames.

Sub-packages
------------
functions   column expressions (names, text, numbers)
sources     readers, sinks, catalogue, artefacts, publication
operators   panel, lookup, privacy, profile, ordering and evaluation operators
learning    feature frames, splits, training, scoring, importance (Spark ML)
plans       raw -> silver -> gold -> train -> score -> publish
streaming   incremental file pick-up
queries     the registered queries and the SQL they are checked against
"""
