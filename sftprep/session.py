"""Session helpers: building a session, the shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "sftprep",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    partition_bytes: int = 256 * 1024 * 1024,
) -> SparkSession:
    """A session with AQE on and the UI off.

    ``master`` is left to spark-submit when None.  On a cluster pass no
    ``shuffle_partitions`` and let AQE coalesce; locally use about the core count.
    ``partition_bytes`` sizes both input splits and AQE's post-shuffle
    partitions, so a task's working set stays a few hundred MB at any scale.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Arrow batches for the chunker and generation UDFs: bound them by
        # bytes as well as rows so a batch of very long documents stays small.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        # paid model calls must not be duplicated by speculative copies
        "spark.speculation": "false",
        # delete checkpoint files once their DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session without the
    setting (tests) gets a private folder; a cluster session without it is an
    error, because a machine-local folder does not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext view (Connect): the server owns the folder
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return root
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/NFS) so lineage cuts survive executor loss"
            )
        root = tempfile.mkdtemp(prefix="sftprep-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for a written intermediate table."""
    root = checkpoint_root(spark)
    return os.path.join(root, "sftprep", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never ``localCheckpoint``).

    Used after non-deterministic or paid stages (model calls) so a lost
    executor re-reads the saved rows instead of calling the model again.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin spread a DataFrame that arrives in fewer partitions than slots.

    A corpus on a cluster arrives in thousands of file splits and is left as
    is (no shuffle).  A small file with one row group arrives as one split;
    spreading it lets the Python chunker use every core.
    """
    spark = df.sparkSession
    try:
        want = min_partitions or spark.sparkContext.defaultParallelism
        # a plan with an exchange is dealt out already, and asking for its
        # partitions would run the upstream stages while planning
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            return df
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Connect session): leave as is
        return df
    if have >= want:
        return df
    return df.repartition(want)


#: bytes of a column's values that a Python step holds at once
SLICE_BYTES = 4 * 1024 * 1024


def byte_slices(batch, column: int, limit: int = SLICE_BYTES):
    """A record batch in slices whose values in a string or binary column have about ``limit`` bytes; a row is never cut."""
    import numpy as np
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(batch)]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def factory_key(factory) -> str:
    """Cache key of a user factory, computed on the driver: a digest of its pickled form.

    Covers code, closure cells and defaults, so two closures made by one
    function never share a worker's client, tokenizer or renderer.
    """
    import hashlib

    from pyspark import cloudpickle

    return hashlib.md5(cloudpickle.dumps(factory)).hexdigest()


_SHIPPED: set[tuple[str, str]] = set()


def ship_code(spark: SparkSession, *package_dirs: str) -> None:
    """Make packages importable in every Python worker (``--py-files`` at run time).

    Python UDF closures refer to functions of these packages by module name,
    so workers must be able to import them whatever their working folder.
    Each package folder is zipped once per application on the driver and
    added with ``addPyFile``, which distributes it to the executors.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    dirs = package_dirs or (os.path.dirname(os.path.abspath(__file__)),)
    for d in dirs:
        d = os.path.abspath(d)
        # Spark serves added files by name, so one package name ships once
        if (app, os.path.basename(d)) in _SHIPPED:
            continue
        # staged on the driver only; addPyFile serves it to every executor
        out_dir = tempfile.mkdtemp(prefix="sftprep-pyfiles-")
        zpath = os.path.join(out_dir, os.path.basename(d) + ".zip")
        parent = os.path.dirname(d)
        with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
            for root, _dirs, files in os.walk(d):
                if "__pycache__" in root:
                    continue
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        zf.write(full, os.path.relpath(full, parent))
        sc.addPyFile(zpath)
        _SHIPPED.add((app, os.path.basename(d)))


def ensure_library_on_workers(spark: SparkSession | None = None) -> None:
    """Ship ``sftprep`` itself before a Python UDF is planned (never raises).

    A no-op after the first call in an application; harmless when the
    package is already installed on the cluster.
    """
    try:
        s = spark or SparkSession.getActiveSession()
        if s is not None:
            ship_code(s)
    except Exception:  # noqa: BLE001 - e.g. a Connect session without addPyFile
        pass
