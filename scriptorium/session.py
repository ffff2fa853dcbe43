"""Session construction and lineage cuts.

Lineage is cut by writing Parquet into the shared folder the cluster names in
``spark.checkpoint.dir``. The setting is read from the session; only a local
session (tests, ``bench.py``) that leaves it unset gets a fresh folder of its
own, a cluster session without it is an error.
"""

from __future__ import annotations

import contextlib
import contextvars
import hashlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "scriptorium") -> SparkSession:
    """A local session tuned for the test data; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SCRIPTORIUM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Reads ``spark.checkpoint.dir``. When it is unset and the master is local,
    a fresh folder is created and registered (as tests do); on a cluster an
    unset value raises, since a machine-local folder is not shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ...) so intermediates survive executor loss"
        )
    root = tempfile.mkdtemp(prefix="scriptorium-ckpt-", dir=os.environ.get("SCRIPTORIUM_SCRATCH"))
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Used where a plan would otherwise evaluate an expensive or
    non-repeatable stage twice (a Python tokenizer, a range partitioning
    whose partition ids are consumed). Retried tasks rewrite their own files,
    so the result is the same after executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20) -> Iterator[None]:
    """Jobs run inside the block hand Python workers Arrow batches of at most
    ``most`` bytes (a row at least). Where Python stages follow one another, or
    rows are ids, JVM and workers otherwise hold several of the default 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(old) <= most:
        yield
        return
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, old)


_INTERMEDIATES: dict[str, list[str]] = {}
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scriptorium_scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the checkpoint folder, released at the end of
    the :func:`intermediates` block it was handed out in, else by
    :func:`release_intermediates`."""
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_root(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}"
    held = _SCOPE.get()
    (_INTERMEDIATES.setdefault(app, []) if held is None else held).append(path)
    return path


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Folders handed out inside the block are deleted at its end, whether it
    fails or not; those of other jobs of the session stay. Frames built from
    them must be written or collected inside the block."""
    held: list[str] = []
    token = _SCOPE.set(held)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _delete(spark, held)


def release_intermediates(spark: SparkSession) -> int:
    """Delete the folders :func:`scratch_path` handed out in this application
    outside of any :func:`intermediates` block; for a session whose frames are
    all done with. Returns the number of folders."""
    paths = _INTERMEDIATES.pop(spark.sparkContext.applicationId, [])
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark would use for it: the one resolver
    for paths that tasks open themselves."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def stream_location(spark: SparkSession, kind: str, source: str, target: str) -> str:
    """The checkpoint folder of the stream from ``source`` to ``target``: the
    same for a restart, another for any other stream."""
    name = hashlib.sha256(f"{qualified(spark, source)}\0{qualified(spark, target)}".encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark).rstrip('/')}/streams/{kind}-{name}"


def spread(df: DataFrame, min_partitions: int | None = None, key: list[str] | None = None) -> DataFrame:
    """Spread ``df`` over the cluster when it arrives in fewer partitions
    than there are cores (a single large file, one row group).

    Wide inputs (many files) pass through untouched, so at scale this adds
    no shuffle; it only keeps a narrow input from serialising the per-row
    work on one core. With a unique row ``key`` the rows are hash-partitioned
    on it (balanced, and deterministic under task retries without the local
    sort a round-robin repartition needs); without one, round-robin.

    The test is the scan's partition count, which assumes the default split
    sizing: a lowered ``spark.sql.files.openCostInBytes`` can cut one
    row group into several splits of which only one holds rows.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *key) if key else df.repartition(target)


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``scriptorium`` importable in the Python workers.

    The Arrow UDFs reference functions of this package; workers resolve them
    by import. The package is zipped once per application and added with
    ``addPyFile`` (workers put it on ``sys.path`` for every task, also when
    already running). A deployment that passes ``--py-files`` or installs the
    package on the executors gets the same result.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    with _SHIP_LOCK:
        if app not in _SHIPPED:
            _ship(sc, spark, app)
            _SHIPPED.add(app)


def _ship(sc, spark: SparkSession, app: str) -> None:
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    if sc.master.startswith("local"):
        folder = os.path.join(tempfile.gettempdir(), f"scriptorium-pyfiles-{app}")
        os.makedirs(folder, exist_ok=True)
        target = os.path.join(folder, "scriptorium.zip")
        with open(target, "wb") as out:
            out.write(buf.getvalue())
    else:  # a shared folder the executors can fetch from
        from pyarrow import fs as pafs

        target = f"{qualified(spark, checkpoint_root(spark)).rstrip('/')}/{app}/pyfiles/scriptorium.zip"
        filesystem, path = pafs.FileSystem.from_uri(target)
        filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(path) as out:
            out.write(buf.getvalue())
    try:
        sc.addPyFile(target)
    except Exception as exc:  # same application, shipped before a module reload
        if "already" not in str(exc).lower():
            raise
