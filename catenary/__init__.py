"""catenary: a PySpark-native engine for linking hierarchical catalogs."""

__version__ = "1.0.0"
