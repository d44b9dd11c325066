"""loadstar: a Spark-native loader and checker for tabular business data.

CSV (and other) files become distributed DataFrames; named rules split good
rows from rejected ones; clean rows land in lake or JDBC tables; quality
reports, change capture, sales marts and a run log are built on top, all as
DataFrame/SQL expressions.

Typical use::

    from loadstar import SALES_JOB, run, read_csv, transform
    res = run(spark, "s3://bucket/in/sales.csv", SALES_JOB, "s3://lake/sales",
              reject_target="s3://lake/sales_rejects",
              run_log_target="s3://lake/etl_execution_log")
"""

__version__ = "0.1.0"

_API = {
    "configure": "session", "get_spark": "session", "stage": "session",
    "read_csv": "sources.csv", "read_directory": "sources.csv",
    "read_source": "sources.csv", "read_jdbc": "sources.csv",
    "transform": "plans.loadjob", "run": "plans.loadjob",
    "JobSpec": "plans.jobspec", "SALES_JOB": "plans.jobspec",
    "JdbcTarget": "sinks.jdbc", "write_jdbc": "sinks.jdbc",
    "load_run": "sinks.lake", "write_table": "sinks.lake",
    "export_csv": "sinks.export", "archive_file": "sinks.files",
    "ingest_available_now": "streaming.ingest",
    "ingest_runs": "streaming.ingest",
    "apply_change_stream": "streaming.ingest",
}


def __getattr__(name):
    """Lazy access to the main entry points (``loadstar.run`` …) without
    importing every module up front."""
    if name in _API:
        import importlib
        return getattr(importlib.import_module(f"{__name__}.{_API[name]}"),
                       name)
    raise AttributeError(name)
