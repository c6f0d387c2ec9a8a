"""How many rows a job moved, counted as they pass, without another scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


class Counts:
    """Rows counted at named places of a plan, known once it has run.

    A place counts whatever passes it, so the scan gives all rows of the source: a filter after
    it is not pushed into the files. With a limit, tasks stop early and counts before it are of
    what they had read by then.
    """

    def __init__(self) -> None:
        self._places: dict[str, Observation] = {}

    def watch(self, frame: DataFrame, place: str) -> DataFrame:
        self._places[place] = Observation()
        return frame.observe(self._places[place], F.count(F.lit(1)).alias("rows"))

    def get(self) -> dict[str, int]:
        return {place: found.get["rows"] for place, found in self._places.items()}
