"""The four loading jobs: extract, transform, insert what is absent, and count.

A job is one lazy plan; extract and transform meet only as DataFrames. Running it is one
write per target table, and its counters are taken inside that write.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import per_second
from tallyhouse.functions.time import Span, chunk_number, moment
from tallyhouse.operators.load import append_if_absent, without_key
from tallyhouse.operators.staging import settled
from tallyhouse.plans import notifications as N
from tallyhouse.plans import orders as O
from tallyhouse.plans import payments as P
from tallyhouse.plans import users as U


@dataclass(frozen=True)
class Target:
    """A warehouse table: its unique key, the part of it a run can touch, and whether metrics have each key once."""

    table: str
    key: tuple[str, ...]
    reach: Column | None = None
    unique: bool = False


@dataclass(frozen=True)
class Job:
    name: str
    extract: DataFrame
    transform: Callable[[DataFrame], DataFrame]
    target: Target
    # A second table computed from the metrics, loaded but not counted.
    rollup: Callable[[DataFrame], DataFrame] | None = None
    rollup_target: Target | None = None
    span: Span | None = None
    # Where the extract and the metrics hold the time of a row; and the rollup of many windows at once, grouped by these columns.
    timed: tuple[str, str] | None = None
    rollup_by: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None


@dataclass
class RunSummary:
    """Counters of one run. Extracted rows are an estimate when executors were lost on the way.

    Failed records are those the transform gave up and those without a key, which lie in the table's rejects. Skipped ones were
    there before, or repeated.
    """

    job_name: str
    status: str = "success"
    records_extracted: int = 0
    records_transformed: int = 0
    records_loaded: int = 0
    records_processed: int = 0
    records_skipped: int = 0
    records_failed: int = 0
    window_start: datetime | None = None
    window_end: datetime | None = None
    duration_seconds: float = 0.0
    start_time: datetime | None = None
    end_time: datetime | None = None
    errors: list[str] = field(default_factory=list)


SUMMARY_SCHEMA = (
    "job_name string, status string, records_extracted long, records_transformed long, records_loaded long, "
    "records_processed long, records_skipped long, records_failed long, window_start timestamp_ntz, window_end timestamp_ntz, "
    "duration_seconds double, start_time timestamp, end_time timestamp, errors array<string>"
)


def user_job(users: DataFrame, span: Span, as_of: datetime, version: int = 2) -> Job:
    transform = U.user_metrics_v1 if version == 1 else U.user_metrics
    key = "user_id" if version == 1 else "user_token"
    return Job(
        "user_analytics",
        U.user_records(users, span, version),
        lambda rows: transform(rows, as_of),
        # No date in the key: a user may be anywhere in the table, and may come twice in the source.
        Target("user_analytics", (key,)),
        span=span,
        timed=("created_at", "registration_date"),
    )


def _days(span: Span, column: str) -> Column:
    """The part of a daily table a span can touch.

    A span that cuts a day is refused: its half day would be stored as the day's total, and stay.
    """
    for end in (span.start, span.end):
        if end.time() != datetime.min.time():
            raise ValueError(f"a daily job needs whole days, not {end}")
    return (F.col(column) >= F.to_date(moment(span.start))) & (F.col(column) <= F.to_date(moment(span.end)))


def order_job(orders: DataFrame, span: Span, statuses: Sequence[str] | None = None, version: int = 2) -> Job:
    return Job(
        "order_analytics",
        O.daily_orders(orders, span, statuses, ordered=False),
        O.order_metrics_v1 if version == 1 else O.order_metrics,
        Target("order_analytics", ("order_date", "status"), _days(span, "order_date"), unique=True),
        span=span,
        timed=("order_date", "order_date"),
    )


def payment_job(payments: DataFrame, span: Span, pii_mode: str = "token", salt: str | None = None) -> Job:
    return Job(
        "payment_analytics",
        P.daily_payments(P.protect_payments(payments, pii_mode, salt), span, ordered=False),
        P.payment_metrics,
        Target("payment_analytics", ("payment_date", "payment_method"), _days(span, "payment_date"), unique=True),
        span=span,
        timed=("payment_date", "payment_date"),
    )


def notification_job(
    notifications: DataFrame, span: Span, channels: Sequence[str] | None = None, version: int = 2
) -> Job:
    def rollup(metrics: DataFrame) -> DataFrame:
        # Rollups of different runs are told apart by their window.
        return N.channel_metrics(metrics).withColumns({
            "window_start": moment(span.start), "window_end": moment(span.end)
        })

    return Job(
        "notification_analytics",
        N.daily_notifications(notifications, span, channels, ordered=False),
        lambda rows: N.notification_metrics(rows, version),
        Target("notification_analytics", ("notification_date", "channel", "notification_type"),
               _days(span, "notification_date"), unique=True),
        rollup,
        Target("channel_analytics", ("window_start", "window_end", "channel"),
               F.col("window_start") == moment(span.start), unique=True),
        span,
        ("notification_date", "notification_date"),
        N.channel_metrics,
    )


def all_jobs(
    sources: Mapping[str, DataFrame], span: Span, as_of: datetime, salt: str | None = None, version: int = 2,
    pii_mode: str = "token",
) -> dict[str, Callable[[], Job]]:
    """The four jobs over ``users``, ``orders``, ``payments`` and ``notifications``.

    Each is built only when it is run, so a source that cannot be read fails its own job alone.
    """
    return {
        "user_analytics": lambda: user_job(sources["users"], span, as_of, version),
        "order_analytics": lambda: order_job(sources["orders"], span, version=version),
        "payment_analytics": lambda: payment_job(sources["payments"], span, pii_mode, salt),
        "notification_analytics": lambda: notification_job(sources["notifications"], span, version=version),
    }


def run_job(job: Job, warehouse: str, dry_run: bool = False) -> RunSummary:
    """Run one job; a failed write fails the run."""
    summary = RunSummary(job.name, start_time=datetime.now(timezone.utc))
    if job.span is not None:
        summary.window_start, summary.window_end = job.span.start, job.span.end
    started = time.monotonic()
    read, made = Observation(), Observation()
    metrics = job.transform(job.extract.observe(read, F.count("*").alias("rows")))
    keyless = F.count_if(F.greatest(*(F.col(c).isNull() for c in job.target.key), F.lit(False)))
    metrics = metrics.observe(made, F.count("*").alias("rows"), keyless.alias("keyless"))
    if dry_run:
        summary.records_loaded = metrics.count()
    else:
        if job.rollup is not None:
            # Both tables come from the same stored rows, whatever happens between the two writes.
            metrics = settled(metrics, job.name)
        target, second = job.target, job.rollup_target
        summary.records_loaded = append_if_absent(
            metrics, f"{warehouse}/{target.table}", target.key, reach=target.reach, unique=target.unique
        )
        if made.get["keyless"]:
            # Repeating a run replaces its own rejects.
            folder = f"{warehouse}/{target.table}_rejects/run={summary.window_start:%Y%m%d%H%M%S}-{summary.window_end:%Y%m%d%H%M%S}" if job.span else f"{warehouse}/{target.table}_rejects/run=all"
            without_key(metrics, target.key).write.mode("overwrite").parquet(folder)
        if job.rollup is not None and second is not None:
            append_if_absent(
                job.rollup(metrics), f"{warehouse}/{second.table}", second.key, reach=second.reach, unique=second.unique
            )
    summary.records_extracted = int(read.get["rows"])
    summary.records_transformed = int(made.get["rows"])
    keyless_rows = 0 if dry_run else int(made.get["keyless"])
    summary.records_processed = summary.records_extracted
    summary.records_failed = summary.records_extracted - summary.records_transformed + keyless_rows
    summary.records_skipped = summary.records_transformed - summary.records_loaded - keyless_rows
    summary.end_time = datetime.now(timezone.utc)
    summary.duration_seconds = time.monotonic() - started
    return summary


def run_jobs(jobs: Mapping[str, Callable[[], Job]] | Iterable[Job], warehouse: str, dry_run: bool = False) -> list[RunSummary]:
    """Run jobs one after the other; one that fails is reported and does not stop the rest."""
    named = jobs.items() if isinstance(jobs, Mapping) else [(j.name, lambda j=j: j) for j in jobs]
    return [_safely(name, make, warehouse, dry_run) for name, make in named]


def _safely(name: str, make: Callable[[], Job], warehouse: str, dry_run: bool, span: Span | None = None) -> RunSummary:
    """The summary of a run, also of one that fails: with its job's name, its window and its times."""
    started, job = datetime.now(timezone.utc), None
    try:
        job = make()
        return run_job(job, warehouse, dry_run)
    except Exception as error:
        span = span if job is None else job.span
        return RunSummary(
            name if job is None else job.name, status="failed", errors=[str(error)], start_time=started, end_time=datetime.now(timezone.utc),
            window_start=span.start if span else None, window_end=span.end if span else None)


def run_backfill(
    make: Callable[[Span], Job], span: Span, warehouse: str, days: int = 7, dry_run: bool = False, name: str = "backfill"
) -> list[RunSummary]:
    """Run a job piece by piece over a long span. Loading is insert-if-absent, so a broken run can be repeated.

    Pieces run one after the other, as a table has one writer at a time; each of them uses the whole cluster.
    ``name`` stands for the job where it could not even be made.
    """
    return [_safely(name, lambda p=p: make(p), warehouse, dry_run, p) for p in span.chunks(days)]


def backfill_chunks(df: DataFrame, column: str, span: Span, days: int = 7) -> DataFrame:
    """How the rows of a span fall into backfill pieces, in one pass instead of one job per piece."""
    last = moment(span.end)
    start = moment(span.start) + F.make_dt_interval(days=F.col("chunk") * days)
    end = moment(span.start) + F.make_dt_interval(days=(F.col("chunk") + 1) * days)
    return (
        df.filter(span.holds(F.col(column)))
        .groupBy(chunk_number(F.col(column), span.start, days).alias("chunk"))
        .agg(F.count("*").alias("rows"))
        .select("chunk", start.alias("chunk_start"), F.least(end, last).alias("chunk_end"), "rows")
        .orderBy("chunk")
    )


def summary_frame(spark: SparkSession, summaries: Sequence[RunSummary]) -> DataFrame:
    """Run summaries as rows, with throughput. One short row per run."""
    rows = spark.createDataFrame([tuple(asdict(s).values()) for s in summaries], SUMMARY_SCHEMA)
    return rows.withColumns({
        "records_per_second": per_second(F.col("records_loaded"), F.col("duration_seconds")),
        "error_count": F.size("errors"),
    })
