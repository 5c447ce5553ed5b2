"""A PySpark library for curating document corpora."""
