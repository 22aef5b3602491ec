"""Session settings and the helpers plans share: lineage cuts, sessions of their own for readers, checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side is refused above this many rows; the join then shuffles and AQE decides.
BROADCAST_ROW_LIMIT = 200_000


def build_session(app: str = "lodgeframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans rely on. ``master`` is left alone on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared folder; a temporary one only for a local session that names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured and sc.master.startswith("local"):
        configured = os.path.join(tempfile.mkdtemp(prefix="lodgeframe-"), "checkpoints")
    if configured:
        sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to reliable storage and continue from the written copy.

    Used where a plan is read more than once and a recomputation could assign rows differently
    (range partitioning, generated positions) or would repeat an expensive join.
    """
    if _checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint(eager=eager)


def own_session(spark: SparkSession, **settings: object) -> SparkSession:
    """A session of the same application with the caller's settings and ``settings``; the caller's stays as it is.

    It is meant for reading many files by name, which are listed by a few tasks a core and not by one task for each file.
    """
    own = spark.newSession()
    given = {k: v for k, v in spark.conf.getAll.items() if spark.conf.isModifiable(k)}
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": 3 * spark.sparkContext.defaultParallelism}
    for key, value in {**given, **listing, **settings}.items():
        own.conf.set(key, value)
    return own


def text_reading(spark: SparkSession) -> SparkSession:
    """A session whose JSON reader prints a number or an object that is asked for as text.

    The default goes back to the file for the characters of each such value, which reads a file many times over.
    """
    return own_session(spark, **{"spark.sql.json.enableExactStringParsing": False})


def handed_over(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Rows of another session, computed there once with its settings, as a frame of this one."""
    done = cut_lineage(df)
    return spark.createDataFrame([], done.schema).unionByName(done)


def at_most(df: DataFrame, rows: int) -> bool:
    """True if ``df`` has no more than ``rows`` rows; reads no further than needed to tell."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint for a side whose row count has been checked, else the side as it is."""
    return F.broadcast(df) if at_most(df, rows) else df
