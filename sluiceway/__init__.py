"""Declarative batch data movement on Spark: tables to tables, tables to graphs and back."""

from sluiceway.graph import NodePattern, PropertyGraph
from sluiceway.plans import read, run_job, run_jobs, session_for
from sluiceway.sinks import write
from sluiceway.sources import Preset, job_stub, preset, presets, register_preset
from sluiceway.spec import Column, JobConfig, Partition, Source, Target

__all__ = [
    "Column",
    "JobConfig",
    "NodePattern",
    "Partition",
    "Preset",
    "PropertyGraph",
    "Source",
    "Target",
    "job_stub",
    "preset",
    "presets",
    "read",
    "register_preset",
    "run_job",
    "run_jobs",
    "session_for",
    "write",
]
