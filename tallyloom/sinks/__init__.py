"""Table sinks that publish a result only once it was checked."""

from tallyloom.sinks.tables import (
    RUN_COLUMN,
    add_run,
    add_staged,
    append_rows,
    committed_runs,
    create_database,
    discard,
    expire_versions,
    publish,
    qualified,
    recover,
    register_view,
    replace_batch,
    stage,
    staged_without,
)

__all__ = [
    "RUN_COLUMN",
    "add_run",
    "add_staged",
    "append_rows",
    "committed_runs",
    "create_database",
    "discard",
    "expire_versions",
    "publish",
    "qualified",
    "recover",
    "register_view",
    "replace_batch",
    "stage",
    "staged_without",
]
