"""Quillon: a PySpark-native engine for document queries and repertoire analytics."""
