"""Session set-up for tests and benchmarks, and shared scratch space."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "tillweave", memory: str = "12g") -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}
_MEMOS: list[dict] = []


def memo() -> dict:
    """A dictionary for frames that read staged folders; its keys begin with the application's id. ``clear_scratch`` empties it."""
    _MEMOS.append({})
    return _MEMOS[-1]


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine, one
    for the whole session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _FALLBACK:
        _FALLBACK[context.applicationId] = tempfile.mkdtemp(prefix="tillweave-")
    return _FALLBACK[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder; ``clear_scratch`` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark reaches."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> int:
    """Remove what this session has staged, and forget the frames that are kept for later
    queries; returns the number of folders. Other frames that read them must be done with."""
    for kept in _MEMOS:
        for key in [k for k in kept if k[0] == spark.sparkContext.applicationId]:
            del kept[key]
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        remove(spark, path)
    return len(made)


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` write to the shared folder."""
    spark.sparkContext.setCheckpointDir(shared_dir(spark))


def staged(df, name: str) -> str:
    """Write ``df`` once, in zstd, to a new path in the shared folder.

    Then the driver collects its garbage: Spark removes the shuffle files of finished
    plans only then, and on large tables those of all steps so far would lie beside the next one's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return path


def materialise(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several consumers share one computation.
    """
    return df.sparkSession.read.schema(df.schema).parquet(staged(df, name))
