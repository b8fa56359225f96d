"""The registered queries: warehouse operators on the driver's tables, with DuckDB SQL."""
