"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are planned for. All of them can be set on
# a session that already runs.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods over 8000 bytes. A larger generated stage
    # would run interpreted; it falls back to one compiled method per operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(app: str = "nightly", master: str | None = None, **conf: object) -> SparkSession:
    """Create a session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="nightly-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset a local
    session uses a folder of this machine; on a cluster other machines could not
    read that, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/nightly/{spark.sparkContext.applicationId}"


_jobs: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other call gets."""
    return "/".join([scratch_root(spark), *_jobs[-1:], f"{name}-{uuid.uuid4().hex[:12]}"])


@contextlib.contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, also after an error.

    For jobs whose results are written elsewhere; frames that read those tables cannot be used afterwards.
    """
    name = f"job-{uuid.uuid4().hex[:12]}"
    _jobs.append(name)
    try:
        yield
    finally:
        _jobs.remove(name)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# Spark's switch for what _write does. Set for single writes only: a frame that runs twice would shuffle anew.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write ``df``; the shuffle files behind it go with the query, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Used to cut lineage where a value must not change when a task is run again
    (partition ids), or where several passes read the same costly input.
    """
    path = scratch_path(df.sparkSession, name)
    _write(df, path, compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``materialize`` what ``make`` returns and delete the intermediate tables made in it, also after an error."""
    path = scratch_path(spark, name)  # outside of the job, so it stays
    with job(spark):
        df = make()
        _write(df, path)
    return spark.read.schema(df.schema).parquet(path)
