"""Queries over the test tables, and the DuckDB SQL that they are held against."""

from . import core, files, flows
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "core", "files", "flows"]
