"""Independent jobs of a sequence at once, on one session."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import SparkSession

from sluiceway.functions.placeholders import resolve_options
from sluiceway.spec import JobConfig, Source, Target
from sluiceway.storage import qualified


def _places(spark: SparkSession, end: "Source | Target") -> set[str]:
    """What a source or target touches: folders, or all that is reached by the same format."""
    options = {name.lower(): value for name, value in resolve_options(end.options).items()}
    if options.get("path"):
        return {qualified(spark, part).rstrip("/") + "/" for part in options["path"].split(",")}
    return {f"{end.format.strip().lower()}:/"}


def _meet(one: set[str], two: set[str]) -> bool:
    """Whether a place of one holds, or lies in, a place of the other."""
    return any(a.startswith(b) or b.startswith(a) for a in one for b in two)


def predecessors(spark: SparkSession, jobs: Sequence[JobConfig]) -> list[set[int]]:
    """The earlier jobs that each must wait for: those that write what it reads or writes, or read what it writes."""
    reads = [_places(spark, job.source) for job in jobs]
    ends = [[job.target] if job.rejected is None else [job.target, job.rejected] for job in jobs]
    writes = [set().union(*(_places(spark, end) for end in found)) for found in ends]
    return [
        {
            n for n in range(later)
            if _meet(writes[n], reads[later] | writes[later]) or _meet(reads[n], writes[later])
        }
        for later in range(len(jobs))
    ]


def run_together(spark: SparkSession, jobs: Sequence[JobConfig], move: Callable, most: int) -> None:
    """Run jobs in threads, each once those it waits for are done; stop all at the first failure.

    Every job has a tag, by which its Spark jobs are cancelled, and a scheduler pool, so that
    ``spark.scheduler.mode`` FAIR shares the cluster among them.
    """
    context, before = spark.sparkContext, predecessors(spark, jobs)
    tag, done, failed = f"jobs-{uuid.uuid4().hex}", set(), None
    running: dict[Future, int] = {}

    def run(n: int) -> None:
        context.setLocalProperty("spark.scheduler.pool", f"{tag}-{n}")
        context.addJobTag(tag)
        try:
            move(jobs[n])
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(most) as threads:
        while len(done) < len(jobs):
            started = {*done, *running.values()}
            for n in range(len(jobs)):
                if failed is None and n not in started and before[n] <= done and len(running) < most:
                    running[threads.submit(run, n)] = n
            if not running:
                break
            if failed is not None:  # also what a job has started since
                context.cancelJobsWithTag(tag)
            for future in wait(running, timeout=1, return_when=FIRST_COMPLETED).done:
                n = running.pop(future)
                error = future.exception()
                if error is None:
                    done.add(n)
                elif failed is None:
                    failed = error
    if failed is not None:
        raise failed
