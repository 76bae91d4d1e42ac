"""Named row counts of a job, gathered while its own actions run."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Counts reach the driver with the listener events of an action.
PATIENCE_SECONDS = 10


class JobMetrics:
    """Counts over several actions of one job.

    ``metrics.count(df, "loaded")`` returns ``df`` unchanged but observed: the
    first action that computes it also counts its rows, so no count costs a
    pass. Further names take a condition. :meth:`values` gives all counts; a
    frame that no action computed (its part of a plan was empty) counts 0.
    """

    def __init__(self) -> None:
        self._observed: list[tuple[Observation, list[str]]] = []
        self._known: dict[str, int] = {}

    def count(self, df: DataFrame, name: str | None = None, **conditions: Column) -> DataFrame:
        counts = [F.count(F.lit(1)).alias(name)] if name else []
        counts += [F.count_if(c).alias(n) for n, c in conditions.items()]
        observation = Observation()
        self._observed.append((observation, [*([name] if name else []), *conditions]))
        return df.observe(observation, *counts)

    def put(self, name: str, value: int) -> None:
        self._known[name] = self._known.get(name, 0) + value

    def values(self) -> dict[str, int]:
        """All counts so far; counts of one name add up."""
        found = dict(self._known)
        until = time.monotonic() + PATIENCE_SECONDS
        for observation, names in self._observed:
            done = observation._jo.future()
            while not done.isCompleted() and time.monotonic() < until:
                time.sleep(0.05)
            counts = observation.get if done.isCompleted() else {}
            for name in names:
                found[name] = found.get(name, 0) + int(counts.get(name) or 0)
        return found
