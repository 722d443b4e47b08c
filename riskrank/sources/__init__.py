"""Inputs (delimited files, column-role lists, literal rows) and shared scratch storage."""

from riskrank.sources.files import (
    Checked,
    inline_rows,
    merged_schema,
    read_checked,
    read_csv,
    read_names,
    read_roles,
    read_splits,
)
from riskrank.sources.roles import Roles
from riskrank.sources.workspace import Workspace, shared_folder

__all__ = [
    "Checked",
    "Roles",
    "Workspace",
    "inline_rows",
    "merged_schema",
    "read_checked",
    "read_csv",
    "read_names",
    "read_roles",
    "read_splits",
    "shared_folder",
]
