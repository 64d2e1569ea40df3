"""A PySpark-native engine for ordered, typographically marked lexical text."""
