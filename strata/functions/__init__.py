"""Column-expression builders over Spark built-ins."""
