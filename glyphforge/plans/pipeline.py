"""Named, ordered, skippable steps on one table, with counters of every step from the one action that reads the result."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Transform = Callable[[DataFrame], DataFrame]
INPUT, ROWS, DROPPED = "input", "rows", "dropped"


@dataclass
class Step:
    """run makes the next table; counters name conditions (SQL) on its rows, such as matched or updated. Columns that serve counters
    alone are named in `drop` and leave with the step."""

    name: str
    run: Transform
    enabled: bool = True
    counters: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()


@dataclass
class Pipeline:
    """Steps in order; nothing runs before the result is read. With counters asked for, they are observed as rows pass, and can
    be read (`summary`) when an action has read the whole result: steps are not run for them, neither once more nor apart."""

    name: str
    steps: list[Step] = field(default_factory=list)
    _observed: dict[str, Observation] = field(default_factory=dict)

    def add(self, name: str, run: Transform, enabled: bool = True, counters: Mapping[str, str] | None = None, drop: tuple[str, ...] = ()) -> Pipeline:
        if name == INPUT or any(s.name == name for s in self.steps):
            raise ValueError(f"two steps are named {name}")
        self.steps.append(Step(name, run, enabled, counters or {}, drop))
        return self

    def run(self, df: DataFrame, count: bool = False) -> DataFrame:
        self._observed = {}
        df = self._observe(INPUT, df, {}) if count else df
        for step in self.steps:
            if not step.enabled:
                continue
            try:
                df = step.run(df)
                df = self._observe(step.name, df, step.counters) if count else df
            except Exception as e:
                raise RuntimeError(f"{self.name}: step {step.name} failed: {e}") from e
            df = df.drop(*step.drop)
        return df

    def _observe(self, name: str, df: DataFrame, counters: Mapping[str, str]) -> DataFrame:
        self._observed[name] = Observation(f"{self.name}: {name}")
        return df.observe(self._observed[name], F.count(F.lit(1)).alias(ROWS), *(F.count_if(F.expr(c)).alias(k) for k, c in counters.items()))

    def summary(self) -> dict[str, dict[str, int]]:
        """Each step's counters, in order: rows after it, rows it dropped (where it left fewer), and its own; for steps that are not
        enabled, none. Waits for the action that reads the result, if that is under way elsewhere; there must be one."""
        out: dict[str, dict[str, int]] = {}
        before = None
        for name, seen in self._observed.items():
            got = {k: int(v or 0) for k, v in seen.get.items()}
            out[name] = got | ({DROPPED: max(0, before - got[ROWS])} if before is not None else {})
            before = got[ROWS]
        return out

    @property
    def counts(self) -> dict[str, int]:
        """The rows after each step."""
        return {name: c[ROWS] for name, c in self.summary().items() if name != INPUT}

    def summary_frame(self, spark: SparkSession) -> DataFrame:
        """step, counter, value."""
        rows = [(step, k, v) for step, own in self.summary().items() for k, v in own.items()]  # a few a step
        return spark.createDataFrame(rows, "step string, counter string, value long")
