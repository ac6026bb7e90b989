"""loomspark: a PySpark-native engine that turns report text and web pages into a trusted table of company figures."""

__version__ = "0.1.0"
