"""sqlhaul: run Spark SQL over named CSV datasets and load the answer into a
dataset as a new upload (append or reload), with exact text round trips."""

from .operators.result import preview, stringify
from .operators.sql import register, run_sql
from .plans.jobs import load_external, load_sql, load_stored
from .session import build_session, scratch_dir, workspace_dir
from .sources.catalog import publish
from .sources.datasets import DatasetRef, Lake, read_dataset, read_parquet, read_result_csv
from .sources.external import JdbcSource, read_query
from .sources.stored import find_query, latest_per_name, put_query, stored_queries, stored_query_index
from .sources.uploads import LoadResult, append, reload, write_upload

__all__ = [
    "DatasetRef",
    "JdbcSource",
    "Lake",
    "LoadResult",
    "append",
    "build_session",
    "find_query",
    "latest_per_name",
    "load_external",
    "load_sql",
    "load_stored",
    "preview",
    "publish",
    "put_query",
    "read_dataset",
    "read_parquet",
    "read_query",
    "read_result_csv",
    "register",
    "reload",
    "run_sql",
    "scratch_dir",
    "stored_queries",
    "stored_query_index",
    "stringify",
    "workspace_dir",
    "write_upload",
]
