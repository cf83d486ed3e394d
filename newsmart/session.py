"""Session settings and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings the operators rely on (UTC days, adaptive joins, Arrow batches)."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for row-local text work over a scan with fewer splits than cores.

    A large table has far more splits than cores and is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for stage tables, checkpoints and stream state, as the session names it.

    Only a local session without the setting gets a folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet stage table in the shared folder and read it back.

    Lineage ends there, and later stages read only the columns and rows they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Counters:
    """Counters of the stages of one run.

    A stage observes them while its result is computed; they can be read, without a second pass, once the result was stored,
    and are those of its first action. A task that is repeated after a lost executor may be counted again.
    """

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def observe(self, results: DataFrame, stage: str, *counters: Column) -> DataFrame:
        """``results`` with the counters of a stage that this run has not counted yet."""
        if stage in self._observed:
            raise ValueError(f"stage {stage} is counted already")
        self._observed[stage] = Observation(_observed_name(stage))
        return results.observe(self._observed[stage], *counters)

    def of(self, stage: str) -> dict[str, int]:
        """The counters of a stage whose result was stored; waits for it otherwise."""
        return self._observed[stage].get

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """(stage, counter, value) of all stages; their results were stored."""
        rows = [(stage, name, value or 0) for stage in self._observed for name, value in self.of(stage).items()]
        return spark.createDataFrame(rows, "stage string, counter string, value long")


def _observed_name(stage: str) -> str:
    return f"{stage}-{uuid.uuid4().hex[:12]}"


def counted(results: DataFrame, stage: str, into: Counters | None = None, **counters: Column) -> DataFrame:
    """Stage results with their counters observed while they are computed.

    Listeners and ``into`` get the counters without a second pass. The node also keeps later filters above the
    stage: pushed below it they would evaluate the stage's expressions a second time.
    """
    named = [value.alias(name) for name, value in counters.items()]
    return into.observe(results, stage, *named) if into else results.observe(_observed_name(stage), *named)
