"""Whole jobs: session, source, steps, target."""

from sluiceway.plans.jobs import read, run_job, run_jobs, session_for

__all__ = ["read", "run_job", "run_jobs", "session_for"]
