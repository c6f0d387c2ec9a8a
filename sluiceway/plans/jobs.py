"""Running jobs: a session, and one lazy plan from source to target."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators.counts import Counts
from sluiceway.operators.rejects import with_reason
from sluiceway.operators.shape import filter_rows, finish, shape
from sluiceway.plans.together import run_together
from sluiceway.sinks.rounds import write_rounds
from sluiceway.sinks.write import check_target, write
from sluiceway.sources.scan import scan
from sluiceway.spec import JobConfig, Source
from sluiceway.storage import Staged

log = logging.getLogger(__name__)


def session_for(job: JobConfig) -> SparkSession:
    """A session with the job's name, master, Spark and Hadoop settings."""
    builder = SparkSession.builder.appName(job.name)
    if job.master:
        builder = builder.master(job.master)
    for key, value in job.conf.items():
        builder = builder.config(key, value)
    for key, value in job.hadoopConfiguration.items():
        builder = builder.config(f"spark.hadoop.{key}", value)
    return builder.getOrCreate()


def read(spark: SparkSession, source: "Source | dict", strict: bool = False) -> DataFrame:
    """The rows a source describes, as one DataFrame."""
    source = Source.of(source)
    return shape(scan(spark, source, strict), source)


def _save(rows: DataFrame, job: JobConfig, strict: bool) -> None:
    if job.source.partition.grid:
        write_rounds(rows, job.target, job.source.partition, strict)
    else:
        write(rows, job.target, strict)


def _move(spark: SparkSession, job: JobConfig, strict: bool, counted: bool = False) -> dict[str, int]:
    """Run the job; the counts of rows, if asked for."""
    counts = Counts() if counted else None
    watch = counts.watch if counts is not None else lambda frame, _: frame
    if job.rejected is not None:
        _move_apart(spark, job, strict, counts, watch)
    else:
        rows = shape(scan(spark, job.source, strict), job.source, counts)
        _save(watch(rows, "written"), job, strict)
    return counts.get() if counts is not None else {}


def _move_apart(
    spark: SparkSession, job: JobConfig, strict: bool, counts: Counts | None, watch: Callable
) -> None:
    """Good rows to the target and others to the second one, over one scan of the source.

    Both are staged first, so each target is written from rows that are there. A target that
    cannot be written leaves the other as it is written by then, the rejected rows first.
    """
    frame = scan(spark, job.source, strict)
    kept = watch(filter_rows(watch(frame, "read"), job.source.where), "kept")
    apart = with_reason(kept, job.source.columns)
    check_target(apart, job.target, strict)
    check_target(apart, job.rejected, strict)
    with Staged(spark) as staged:
        rows = staged.rows(apart)
        bad = rows.where("reason IS NOT NULL").select("bad.*", "reason")
        good = finish(rows.where("reason IS NULL").select("good.*"), job.source)
        write(watch(bad, "rejected"), job.rejected, strict)
        _save(watch(good, "written"), job, strict)


def _warn_of_ignored_settings(job: JobConfig) -> None:
    if job.conf or job.hadoopConfiguration:
        log.warning("job '%s': conf and hadoopConfiguration are ignored, Spark runs", job.name)


def run_job(
    spark: SparkSession | None,
    job: Any,
    close_session: bool = False,
    strict: bool = False,
    counts: bool = False,
) -> dict[str, int]:
    """Run one job; ``job`` is anything ``JobConfig.load`` takes.

    Without a session one is made from the job's settings. A session that is
    given keeps its own settings. ``strict`` rejects placeholders in options
    that cannot be replaced. With ``counts`` it returns how many rows were
    ``read``, ``kept`` by the filter and ``written`` (and ``rejected``).
    """
    job = JobConfig.load(job)
    if spark is not None:
        _warn_of_ignored_settings(job)
    session = spark or session_for(job)
    try:
        return _move(session, job, strict, counted=True) if counts else _move(session, job, strict)
    finally:
        if close_session:
            session.stop()


def run_jobs(
    spark: SparkSession | None,
    jobs: "Iterable[Any] | str",
    close_session: bool = False,
    strict: bool = False,
    together: int = 1,
) -> None:
    """Run jobs in order, up to the first that fails.

    ``jobs`` is anything ``JobConfig.load_all`` takes. A session that is given
    serves them all. Without one, jobs in a row that ask for the same settings
    share a session; other settings start a new one, so none reach a later job.

    On a session that is given, up to ``together`` jobs run at once, each in a
    scheduler pool of its own. A job waits for earlier ones that touch a place it
    reads or writes. At the first failure running jobs are cancelled, no other
    starts, and the failure is raised.
    """
    if together > 1:
        if spark is None:
            raise ValueError("jobs run at once on a session that is given")
        waiting = JobConfig.load_all(jobs)
        for job in waiting:
            _warn_of_ignored_settings(job)
        try:
            run_together(spark, waiting, lambda job: _move(spark, job, strict), together)
        finally:
            if close_session:
                spark.stop()
        return
    session, settings, started = spark, None, False
    try:
        for job in JobConfig.load_all(jobs):
            wanted = (job.master, job.conf, job.hadoopConfiguration)
            if spark is not None:
                _warn_of_ignored_settings(job)
            elif wanted != settings:
                if started:
                    session.stop()
                # A session that was there before is used, and is not ours to stop.
                started = SparkSession.getActiveSession() is None
                session, settings = session_for(job), wanted
            _move(session, job, strict)
    finally:
        if close_session and session is not None:
            session.stop()
