"""Reading: format presets and the scan that opens any Spark data source."""

from sluiceway.sources.presets import (
    Preset,
    UnknownPreset,
    job_stub,
    preset,
    presets,
    register_preset,
    resolve_format,
)
from sluiceway.sources.scan import MissingConnector, scan

__all__ = [
    "MissingConnector",
    "Preset",
    "UnknownPreset",
    "job_stub",
    "preset",
    "presets",
    "register_preset",
    "resolve_format",
    "scan",
]
