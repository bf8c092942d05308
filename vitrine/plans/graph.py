"""Tables that are built from one another, several at a time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitrine.sources.tables import COMPRESSION, day_slices, shuffles_dropped

Build = Callable[..., DataFrame]


@dataclass(frozen=True)
class Model:
    """A table, made of the tables it names, which ``build`` is given in that order.

    With ``instant``, a timestamp of its rows, it may be written by slices of days.
    """

    build: Build
    needs: tuple[str, ...] = ()
    instant: str | None = None


@dataclass
class Built:
    """Stored tables and how many rows were written to each; what failed, and what was left out for that."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    failed: dict[str, Exception] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


class ModelsFailed(RuntimeError):
    """Some tables couldn't be built; ``built`` has the others."""

    def __init__(self, built: Built) -> None:
        super().__init__("; ".join(f"{name}: {error}" for name, error in built.failed.items()))
        self.built = built


def build_models(
    spark: SparkSession, models: dict[str, Model], home: str, given: dict[str, DataFrame] | None = None, at_once: int = 4
) -> Built:
    """Stores every model as ``home``/name as soon as what it needs is stored, ``at_once`` at a time.

    Small tables leave most of a cluster idle while their last tasks run, so
    jobs of several are mixed; each has a pool of its own, which a session with
    the FAIR scheduler serves in turns.  ``given`` are tables that are there.
    Rows are counted while they are written, and what a table shuffled goes when
    it is stored.  When a model fails, those that
    need it are left out, the others are built, and ModelsFailed tells of it.
    """
    _checked(models, set(given or ()))
    done = Built(tables=dict(given or {}))
    waiting, running = dict(models), {}

    def store(name: str) -> tuple[DataFrame, int]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        model = models[name]
        table = model.build(*(done.tables[needed] for needed in model.needs))
        path, rows = f"{home}/{name}", 0
        slices = day_slices(table, F.to_date(model.instant)) if model.instant else [table]
        for number, part in enumerate(slices):
            counted = Observation()
            part = part.observe(counted, F.count(F.lit(1)).alias("rows"))
            part.write.mode("append" if number else "overwrite").option("compression", COMPRESSION).parquet(path)
            rows += counted.get["rows"]
        return spark.read.schema(table.schema).parquet(path), rows

    with shuffles_dropped(spark), ThreadPoolExecutor(at_once) as pool:
        while waiting or running:
            lost = {*done.failed, *done.skipped}
            for name in [n for n, m in waiting.items() if lost.intersection(m.needs)]:
                del waiting[name]
                done.skipped.append(name)
            for name in [n for n, m in waiting.items() if all(needed in done.tables for needed in m.needs)]:
                del waiting[name]
                running[pool.submit(inheritable_thread_target(spark)(store), name)] = name
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    _note(done, running.pop(future), future)
    if done.failed:
        raise ModelsFailed(done)
    return done


def _note(done: Built, name: str, future: Future) -> None:
    if future.exception() is None:
        done.tables[name], done.rows[name] = future.result()
    else:
        done.failed[name] = future.exception()


def _checked(models: dict[str, Model], given: set[str]) -> None:
    """Refuses models that need an unknown table, or one another in a circle."""
    known, left = set(given), dict(models)
    while left:
        ready = [name for name, model in left.items() if known.issuperset(model.needs)]
        if not ready:
            raise ValueError(f"no way to build {', '.join(sorted(left))}")
        known.update(ready)
        for name in ready:
            del left[name]
