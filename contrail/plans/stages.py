"""Named stages run in turn, each written and read again, and a gate that must hold before they run."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, dict[str, DataFrame]], DataFrame]


class GateError(ValueError):
    """What a configuration breaks, all of it."""


def gate(rules: dict[str, Callable[[dict], bool]], config: dict) -> None:
    """Raises GateError with the names of all rules that the configuration breaks; a rule that fails is broken."""

    def holds(rule: Callable[[dict], bool]) -> bool:
        try:
            return bool(rule(config))
        except (KeyError, TypeError, ValueError):
            return False

    broken = [name for name, rule in rules.items() if not holds(rule)]
    if broken:
        raise GateError(f"not met: {', '.join(broken)}")


def chosen(names: list[str], skip: Iterable[str] = (), start: str | None = None, only: str | None = None) -> list[str]:
    """The stages to run: one alone, or all from `start` on but for those to skip; an unknown name is an error."""
    skip = set(skip)
    unknown = ({*skip} | ({start} if start else set()) | ({only} if only else set())) - set(names)
    if unknown:
        raise ValueError(f"no such stages: {', '.join(sorted(unknown))}")
    if only:
        return [only]
    return [n for n in names[names.index(start) if start else 0 :] if n not in skip]


def written(spark: SparkSession, path: str) -> bool:
    """Whether a stage's table is there: its files only come into its folder when the whole write is committed."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise
    return True


def run_stages(spark: SparkSession, stages: dict[str, Stage], folder: str, resume: bool = True, **choice) -> dict[str, DataFrame]:
    """Runs stages in order; each gets the tables of those before it, as they were written. With `resume`, a stage whose
    table is complete is not run again. Gives the tables of all stages that are there."""
    todo, tables = set(chosen(list(stages), **choice)), {}
    for name, stage in stages.items():
        path = f"{folder}/{name}"
        if name in todo and not (resume and written(spark, path)):
            stage(spark, dict(tables)).write.mode("overwrite").parquet(path)
        if written(spark, path):
            tables[name] = spark.read.parquet(path)
    return tables
