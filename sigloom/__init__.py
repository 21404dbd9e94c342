"""A PySpark-native engine for signatures, fingerprints, packing, queue replay and duplicates."""
