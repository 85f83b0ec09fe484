"""The run ledger: appended events folded to the latest state of each run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("rows_fetched", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("quality", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
# An event also says which micro-batch of which stream its run loads; null for batch runs.
EVENT = T.StructType(
    [
        *RUNS.fields,
        T.StructField("event_seq", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
# Landed files that no run has loaded: the latest entry of a file counts, without a problem once it is loaded.
REFUSED = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("problem", T.StringType()),
    ]
)

MAX_LIMIT = 200
STATUS_RUNS = 10
ERROR_CHARS = 60


def fold(events: DataFrame, run: str = "run_id", seq: str = "event_seq", keep: bool = False) -> DataFrame:
    """Latest event of each run; combines map-side, whatever the events per run. ``keep`` keeps ``seq``."""
    state = [name for name in events.columns if name != run and (keep or name != seq)]
    last = F.max_by(F.struct(*state), F.col(seq)).alias("_last")
    return events.groupBy(run).agg(last).select(run, "_last.*")


def last_runs(runs: DataFrame, limit: int = 20, run: str = "run_id") -> DataFrame:
    """The newest runs first, without their quality text."""
    shown = [name for name in runs.columns if name != "quality"]
    return runs.select(*shown).orderBy(F.desc(run)).limit(limit)


def runs_page(runs: DataFrame, limit: int = 20) -> DataFrame:
    """:func:`last_runs` behind the read query's argument range."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return last_runs(runs, limit)


def status_lines(runs: DataFrame, limit: int = STATUS_RUNS) -> DataFrame:
    """The last runs as shown to an operator: no nulls, errors cut short."""
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    return last_runs(runs, limit).select(
        "run_id",
        "started_at",
        "status",
        count("rows_fetched"),
        count("rows_inserted"),
        count("rows_updated"),
        F.substring(F.coalesce(F.col("error"), F.lit("")), 1, ERROR_CHARS).alias("error"),
    )
