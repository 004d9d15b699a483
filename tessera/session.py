"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package is written for.  AQE re-plans at stage
# boundaries (partition coalescing, skew-join splitting, runtime broadcast
# conversion based on measured sizes); ANSI mode makes bad casts fail loudly.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the caller supplies the session; nothing in the operators
    depends on it being created here.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts (materialised intermediate tables).

    Uses the session's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only a local-mode session without one gets a fresh scratch folder;
    a cluster session without a shared checkpoint folder is an error, because
    a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared (distributed) folder")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


# the open scopes of this thread (or task): another thread's scope never sees them
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one job run
    (recorded in the innermost open ``scratch_scope``)."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, on exit, the intermediate tables written inside the block.

    Query functions return DataFrames that may still read their lineage
    cuts, so the caller decides when results have been consumed::

        with scratch_scope(spark):
            rows = hop_distance(graph, 1).collect()

    Only folders created by ``scratch_path`` inside the block are removed,
    through the Hadoop FileSystem of each path (works for any shared store).
    """
    created: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), created))
    try:
        yield created
    finally:
        _SCOPES.reset(token)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in created:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(p)}")     # of ``bucketed``
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


def materialize(df, name: str):
    """Cut the lineage of ``df``: write it once as Parquet below the shared
    checkpoint folder and return a DataFrame reading it back.

    Used where a result feeds several consumers (each would otherwise
    re-run the whole lineage) or feeds a driver loop.  The files live in
    the cluster's shared folder, so a lost executor costs a re-read, not a
    recomputation; the read-back plan also carries exact file sizes for the
    join planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _table_name(path: str) -> str:
    return "tessera_" + path.rsplit("/", 1)[1].replace("-", "_")


def bucketed(df, name: str, buckets: int, *keys: str):
    """``df`` written once below the shared checkpoint folder, in ``buckets`` hash
    buckets of ``keys``, one sorted file each, and read back as such: a join on
    these keys moves the other side's rows only.  Like ``materialize`` a lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(_table_name(path), format="parquet"))
    return spark.table(_table_name(path))


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.sparkContext.defaultParallelism or os.cpu_count() or 1)
