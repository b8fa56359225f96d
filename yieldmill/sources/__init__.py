"""Readers: relational tables, files and lakehouse tables."""

from yieldmill.sources.files import read_csv, read_json, read_text, with_source_file
from yieldmill.sources.jdbc import JdbcSplit, read_jdbc
from yieldmill.sources.lake import Lake, Table

__all__ = [
    "JdbcSplit",
    "Lake",
    "Table",
    "read_csv",
    "read_jdbc",
    "read_json",
    "read_text",
    "with_source_file",
]
