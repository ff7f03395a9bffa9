"""Queries over the driver tables: (spark, sf_dir) -> DataFrame, each with DuckDB SQL for the same rows."""
