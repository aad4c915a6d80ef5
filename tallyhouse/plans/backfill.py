"""A long span loaded in one pass over its source, with an outcome for each of its pieces.

`jobs.run_backfill` runs a job for each piece, and each reads the source again. Here a job is made once for the whole
span: its extract, which holds no more than the rows or daily figures of the span, is settled, and every later step works on
that. A row's piece follows from its own time. What a run of one piece would have loaded, rejected and counted comes
out of aggregates by piece, so the tables and the summaries are those of the loop.

Where the pass fails, its pieces are tried in two halves, and so on, until the pieces that cannot be loaded stand alone: they
are reported as failed and all others are loaded, in a number of passes that grows with the logarithm of the pieces for
each damaged one. Loading is insert-if-absent, so rows that a pass had loaded before it failed count as skipped.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.time import Span, chunk_number, moment
from tallyhouse.operators.load import absent_rows, append_if_absent, existing, without_key
from tallyhouse.operators.staging import settled
from tallyhouse.plans.jobs import Job, RunSummary

PIECE = "_piece"


def backfill_at_once(
    make: Callable[[Span], Job], span: Span, warehouse: str, days: int = 7, name: str = "backfill"
) -> list[RunSummary]:
    """Summaries of all pieces in their order. ``name`` stands for the job where it could not even be made."""
    pieces = span.chunks(days)
    return _attempt(make, pieces, warehouse, days, name) if pieces else []


def _attempt(make: Callable[[Span], Job], pieces: Sequence[Span], warehouse: str, days: int, name: str) -> list[RunSummary]:
    began, job = datetime.now(timezone.utc), None
    try:
        job = make(Span(pieces[0].start, pieces[-1].end))
        return _load(job, pieces, warehouse, days, began)
    except Exception as error:
        if len(pieces) == 1:
            return [RunSummary(
                name if job is None else job.name, "failed", errors=[str(error)], start_time=began, end_time=datetime.now(timezone.utc),
                window_start=pieces[0].start, window_end=pieces[0].end)]
    half = len(pieces) // 2
    return _attempt(make, pieces[:half], warehouse, days, name) + _attempt(make, pieces[half:], warehouse, days, name)


def piece_of(column: str, start: datetime, days: int) -> Column:
    """Number of the piece that a date or a timestamp lies in."""
    return chunk_number(F.col(column).cast("timestamp_ntz"), start, days).alias(PIECE)


def _window(pieces: Sequence[Span], days: int) -> dict[str, Column]:
    """Start and end of a row's piece; the last may be shorter."""
    start = moment(pieces[0].start)
    return {
        "window_start": start + F.make_dt_interval(days=F.col(PIECE) * days),
        "window_end": F.least(start + F.make_dt_interval(days=(F.col(PIECE) + 1) * days), moment(pieces[-1].end)),
    }


def _counts(rows: DataFrame) -> dict[int, int]:
    """Rows of each piece: as many short rows as there are pieces."""
    return {r[PIECE]: r["count"] for r in rows.groupBy(PIECE).count().collect()}


def _load(job: Job, pieces: Sequence[Span], warehouse: str, days: int, began: datetime) -> list[RunSummary]:
    if job.timed is None:
        raise ValueError(f"{job.name} doesn't say which columns hold the time of its rows")
    clock, target, start = time.monotonic(), job.target, pieces[0].start
    extract = settled(job.extract, f"{job.name}-extract")  # the one pass over the source
    metrics = job.transform(extract)
    # The piece stands first: of rows with one key, those of the earliest piece go in, as they would one after the other.
    metrics = settled(metrics.select(piece_of(job.timed[1], start, days), *metrics.columns), f"{job.name}-metrics")
    held = existing(metrics.sparkSession, f"{warehouse}/{target.table}")
    loaded = settled(absent_rows(metrics, held, target.key, target.reach, target.unique), f"{job.name}-loaded")
    keyless = without_key(metrics, target.key)
    counts = [_counts(rows) for rows in (extract.select(piece_of(job.timed[0], start, days)), metrics, loaded, keyless)]
    loaded.drop(PIECE).write.mode("append").parquet(f"{warehouse}/{target.table}")
    if counts[3]:
        # The same folders as those of runs piece by piece; repeating a piece replaces its own rejects.
        window = _window(pieces, days)
        run = F.concat_ws("-", *(F.date_format(window[c], "yyyyMMddHHmmss") for c in ("window_start", "window_end")))
        rejects = keyless.withColumn("run", run).drop(PIECE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rejects.partitionBy("run").parquet(f"{warehouse}/{target.table}_rejects")
    if job.rollup_by is not None and job.rollup_target is not None:
        second = job.rollup_target
        rolled = job.rollup_by(metrics.withColumns(_window(pieces, days)), ("window_start", "window_end"))
        reach = F.col("window_start").between(moment(start), moment(pieces[-1].start))
        append_if_absent(rolled, f"{warehouse}/{second.table}", second.key, reach=reach, unique=second.unique)
    seconds, ended = time.monotonic() - clock, datetime.now(timezone.utc)
    return [
        _summary(job.name, piece, [c.get(i, 0) for c in counts], began, ended, seconds)
        for i, piece in enumerate(pieces)
    ]


def _summary(name: str, piece: Span, counts: Sequence[int], began: datetime, ended: datetime, seconds: float) -> RunSummary:
    extracted, made, loaded, keyless = counts
    return RunSummary(
        name, records_extracted=extracted, records_transformed=made, records_loaded=loaded, records_processed=extracted,
        records_skipped=made - loaded - keyless, records_failed=extracted - made + keyless,
        window_start=piece.start, window_end=piece.end, duration_seconds=seconds, start_time=began, end_time=ended)
