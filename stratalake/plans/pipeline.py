"""Running layer steps in order, with lineage guard, run metrics and a verdict."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stratalake.session import pin, remove, unpin
from stratalake.sources.sinks import PACKED, write_by_month, write_full

# Which layers a layer may read.
MAY_READ = {
    "bronze": {"source"},
    "silver": {"bronze"},
    "gold": {"silver", "gold"},
}


class LineageError(ValueError):
    """A step reads a layer it must not depend on, or a table no earlier step writes."""


@dataclass(frozen=True)
class Step:
    """One table: its ``layer.name``, the tables it reads and how it is built from them.

    ``month`` names the event time of a fact that is written by months; ``widen`` then adds the
    columns that follow from a built row alone, after the rows were gathered by month. ``rejects``
    tells, for a built row, why it is rejected (NULL if it is not): the table is then written once,
    by outcome, and its rejected rows can be read and listed as ``<target>_rejected``.
    """

    target: str
    reads: Sequence[str]
    build: Callable[..., DataFrame]
    month: str | None = None
    rejects: Callable[[DataFrame], Column] | None = None
    widen: Callable[[DataFrame], DataFrame] | None = None

    @property
    def layer(self) -> str:
        return self.target.split(".")[0]


@dataclass
class RunResult:
    batch_id: str
    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def total_rows(self) -> int:
        return sum(self.rows.values())

    @property
    def bi_ready(self) -> bool:
        return bool(self.rows) and not self.errors

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per step, with its rows or its error."""
        lines = [(t, n, "ok", None) for t, n in self.rows.items()]
        lines += [(t, None, "error", e) for t, e in self.errors.items()]
        return spark.createDataFrame(lines, "table_name string, row_count bigint, status string, error string")


def check_lineage(steps: Sequence[Step], sources: Sequence[str]) -> None:
    """Fail before any work when a step breaks the layer order."""
    known = set(sources)
    for step in steps:
        for table in step.reads:
            if table not in known:
                raise LineageError(f"{step.target} reads {table}, which no earlier step provides")
            if table.split(".")[0] not in MAY_READ[step.layer]:
                raise LineageError(f"{step.target} must not read {table}")
        known.add(step.target)


# How the rows of a table with rejects are stored: by outcome, and with the reason.
OUTCOME, REASON = "br_outcome", "rejected_columns"


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows of ``df``, and the rejected ones, while another action runs, without a second pass."""
    seen = Observation(name)
    rejected = F.count(REASON) if REASON in df.columns else F.count(F.lit(None))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), rejected.alias("rejected")), seen


def _by_outcome(df: DataFrame, reason: Column) -> DataFrame:
    marked = df.withColumn(REASON, reason)
    return marked.withColumn(OUTCOME, F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected"))


def _read_outcomes(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The rows that came through, and the rejected ones with their reason."""
    whole = spark.read.schema(schema).parquet(path)
    return whole.drop(REASON, OUTCOME), whole.where(F.col(OUTCOME) == "rejected").drop(OUTCOME)


def land_corrected(
    spark: SparkSession, path: str, corrected: DataFrame, key: str, rejects: Callable[[DataFrame], Column]
) -> tuple[int, int]:
    """Replay rejected rows of the table at ``path`` in their corrected form.

    ``corrected`` has the columns of the table, under the batch they were landed with. Rows that
    now pass move to the outcome ``corrected``, the others stay rejected with their reason.
    Only these two partitions are written, so replaying the same rows again changes nothing.
    Returns how many rows came through by now and how many are still rejected.
    """
    whole = spark.read.parquet(path)
    fresh = _by_outcome(corrected, rejects(corrected)).withColumn(
        OUTCOME, F.when(F.col(REASON).isNull(), "corrected").otherwise("rejected")
    )
    before = whole.where(F.col(OUTCOME).isin("rejected", "corrected")).join(corrected.select(key), key, "left_anti")
    # Read before it is replaced.
    rows = pin(before.select(fresh.columns).unionByName(fresh), "replayed")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**PACKED).partitionBy(OUTCOME).parquet(path)
    found = {r[0]: r[1] for r in rows.groupBy(OUTCOME).count().collect()}
    if "rejected" not in found:  # a dynamic overwrite leaves a partition without new rows as it was
        gone = f"{path}/{OUTCOME}=rejected"
        remove(spark, gone)
    unpin(rows)
    return found.get("corrected", 0), found.get("rejected", 0)


def run(
    spark: SparkSession,
    steps: Sequence[Step],
    sources: Mapping[str, DataFrame],
    folder: str,
    batch_id: str,
    on_error: str = "fail",
    parallel: int = 4,
) -> RunResult:
    """Build and write every step below ``folder``.

    Later steps read the written tables, so each table is computed once. A step starts as
    soon as its own inputs are written; up to ``parallel`` steps share the cluster.
    ``on_error`` is ``fail`` (start nothing after the first error) or ``collect`` (note it,
    skip what depends on it, go on); an error is never reported as zero rows.
    """
    if on_error not in ("fail", "collect"):
        raise ValueError(f"unknown on_error: {on_error}")
    check_lineage(steps, list(sources))
    tables = dict(sources)
    done: dict[str, int] = {}
    errors: dict[str, str] = {}

    def write(step: Step) -> tuple[dict[str, int], dict[str, DataFrame]]:
        missing = [t for t in step.reads if t not in tables]
        if missing:
            raise LineageError(f"input failed earlier: {', '.join(missing)}")
        built = step.build(*[tables[t] for t in step.reads])
        if step.rejects:
            built = _by_outcome(built, step.rejects(built))
        counted, seen = observe_counts(built, step.target)
        path = f"{folder}/{step.target.replace('.', '/')}"
        if step.rejects:
            writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**PACKED)
            writer.partitionBy(OUTCOME).parquet(path)
            through, rejected = _read_outcomes(spark, path, counted.schema)
            name = f"{step.target}_rejected"
            return {step.target: seen.get["rows"], name: seen.get["rejected"]}, {step.target: through, name: rejected}
        if step.month:
            write_by_month(counted, path, step.month, step.widen)
            whole = step.widen(built) if step.widen else built
            schema = StructType([*whole.schema.fields]).add("month", StringType())
            return {step.target: seen.get["rows"]}, {step.target: spark.read.schema(schema).parquet(path)}
        write_full(counted, path)
        return {step.target: seen.get["rows"]}, {step.target: spark.read.schema(counted.schema).parquet(path)}

    waiting, running = list(steps), {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while waiting or running:
            open_tables = {s.target for s in waiting} | {s.target for s in running.values()}
            for step in [s for s in waiting if not open_tables.intersection(s.reads)]:
                waiting.remove(step)
                running[pool.submit(write, step)] = step
            finished: set[Future] = wait(running, return_when=FIRST_COMPLETED).done
            for future in finished:
                step, error = running.pop(future), future.exception()
                if error is None:
                    rows, made = future.result()
                    done.update(rows)
                    tables.update(made)
                elif on_error == "fail":
                    wait(running)
                    raise error
                else:
                    errors[step.target] = str(error).splitlines()[0]
    order = [name for step in steps for name in (step.target, f"{step.target}_rejected")]
    return RunResult(
        batch_id,
        {t: done[t] for t in order if t in done},
        {t: errors[t] for t in order if t in errors},
        {t: tables[t] for t in order if t in done},
    )
