"""A PySpark-native analytics engine for gene-editing sequencing experiments."""
