"""Table and feature operators: each is ``(DataFrame, columns, options) -> DataFrame``."""
