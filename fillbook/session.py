"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession

# Settings every job relies on: UTC so epoch <-> timestamp is stable, AQE so
# join strategy / skew splitting / partition coalescing are decided on runtime
# sizes rather than guesses.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A few keys with costly work each (a market's recursion) stay spread over
    # the cores instead of being merged into one task for their few bytes.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fillbook", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster pass ``master=None`` so the launcher decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fillbook`` importable on every executor's Python workers.

    Pandas UDFs refer to functions of this package by module name, so the
    workers must be able to import it. The package is zipped once per
    application and added with ``addPyFile`` (Spark serves it to executors
    and puts it on their ``sys.path``).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="fillbook-pkg-"), "fillbook.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset (local tests) do we
    pick a scratch folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="fillbook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Within it, the exchange files of a finished write or other action are removed
    at once, on all executors. Else they stay until the driver happens to collect
    its garbage, beside those of the steps that follow. A frame that is executed
    twice makes its exchange files anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Rows whose exchange may lie on disk at a time, where a large table is written in portions.
PORTION_ROWS = 1 << 25


def portions(counts: list[tuple]) -> list[list]:
    """Values in order, from ``(value, rows)``, as consecutive groups of at most
    ``PORTION_ROWS`` rows, or of one value that has more. One group at least."""
    groups, room = [[]], PORTION_ROWS
    for value, n in sorted(counts, key=lambda x: (x[0] is not None, x[0])):
        if groups[-1] and n > room:
            groups.append([])
            room = PORTION_ROWS
        groups[-1].append(value)
        room -= n
    return groups


def among(c: Column, values: list) -> Column:
    """Whether ``c`` is one of ``values``, which may hold None."""
    known = c.isin([v for v in values if v is not None])
    return known | c.isNull() if None in values else known


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialize(df, name: str = "cut"):
    """Write ``df`` as a table in the shared folder and read it back.

    For what several branches of a plan read: without it each of them evaluates
    the whole upstream plan again. A lost executor costs a re-read of the files,
    and readers take only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
