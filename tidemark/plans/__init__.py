"""The medallion flow: raw -> silver -> gold -> train -> score -> publish."""
