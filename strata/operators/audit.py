"""Row counts of a cleaning's steps, taken within one run of it.

Every step of the pipeline is observed where it stands, so one execution yields all figures: what came in, what a step dropped and what went
out.  The figures are those of the run itself; nothing is recomputed to be counted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import observed
from ..specs import EntitySpec
from . import clean as C


class StepCounts:
    """Observed metrics by step; read them after the run that :meth:`through` is part of."""

    def __init__(self):
        self.observations: dict[str, Observation] = {}

    def through(self, df: DataFrame, step: str, **metrics) -> DataFrame:
        """``df`` with the step's rows, and any further aggregates, counted as they pass."""
        obs = self.observations[step] = Observation(f"{step}_{uuid.uuid4().hex}")
        return df.observe(obs, F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in metrics.items()))

    def of(self, step: str, metric: str = "rows") -> int:
        return int(observed(self.observations[step]).get(metric, 0))


def run_to_end(df: DataFrame) -> None:
    """Execute a plan in full without keeping its rows."""
    df.write.format("noop").mode("overwrite").save()


def cleaning_run(df: DataFrame, spec: EntitySpec, counts: StepCounts) -> DataFrame:
    """The silver cleaning of ``df`` with its input, its keyed rows and its output counted as ``<entity>_in``, ``_keyed`` and ``_out``."""
    missing = F.lit(False)
    for k in spec.key:
        missing = missing | F.col(k).isNull()
    came = counts.through(df, f"{spec.name}_in", null_keys=F.count_if(missing))
    return counts.through(C.clean_entity(came, spec), f"{spec.name}_out")


def cleaning_audit(inputs: list[tuple[EntitySpec, DataFrame]]) -> list[tuple[str, int, int, int, int]]:
    """``(entity, rows_in, duplicates_removed, null_keys_dropped, rows_out)`` of each cleaning, from one run of all of them.

    Every input is scanned once.  The removed duplicates are the rows that came in with a key and did not go out.
    """
    counts, sink = StepCounts(), None
    for spec, df in inputs:
        one = cleaning_run(df, spec, counts).select(F.lit(1).alias("one"))
        sink = one if sink is None else sink.union(one)
    run_to_end(sink)
    out = []
    for spec, _ in inputs:
        came, bare, went = counts.of(f"{spec.name}_in"), counts.of(f"{spec.name}_in", "null_keys"), counts.of(f"{spec.name}_out")
        dropped = 0 if spec.keep_null_keys else bare
        out.append((spec.name, came, came - dropped - went, dropped, went))
    return out
