"""Session settings and the shared work folder.

On a cluster the session comes from the platform; ``work_root`` only reads
``spark.checkpoint.dir`` from it. A local folder is made only when that
setting is unset (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that are safe to apply to any session at run time.
RUNTIME_CONF = {
    # Instants without an offset, and date casts, must not depend on where the job runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot does not JIT methods over 8000 bytecode bytes; fall back from
    # whole-stage codegen before a fused stage gets that large.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings that only a new session takes (on a cluster: ``spark-submit --conf``).
STATIC_CONF = {
    # PySpark looks up the caller's source line for every column expression, for
    # error messages; building the report takes 0.05 s without it, 0.25 s with it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigil", extra: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and benchmarks (no UI, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RUNTIME_CONF, **STATIC_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When it is unset a local folder is created once and set as the
    checkpoint directory, but only for a ``local[...]`` master: on a cluster
    an unset setting is an error, never a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        # setCheckpointDir appends a random child folder; share its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="vigil-checkpoint-")
    if sc is not None:
        sc.setCheckpointDir(root)
    else:
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme and authority, however it was written."""
    fs, p = _hadoop_path(spark, path)
    return str(fs.makeQualified(p).toString()).rstrip("/")


def holds_file(spark: SparkSession, path: str, pattern: str | None, recursive: bool) -> bool:
    """Whether a folder holds a data file whose name matches the glob; stops at the first hit."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isFile():
        return True
    accept = spark._jvm.org.apache.hadoop.fs.GlobFilter(pattern or "*")
    root = str(fs.makeQualified(p).toString())
    files = fs.listFiles(p, recursive)
    while files.hasNext():
        name = files.next().getPath()
        below = str(name.toString())[len(root):].split("/")
        if not any(part.startswith(("_", ".")) for part in below) and accept.accept(name):
            return True
    return False


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step; one that is there stays."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        fs.create(p, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below a folder; none where there is no such folder."""
    fs, p = _hadoop_path(spark, path)
    out: list[str] = []
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            name = files.next().getPath()
            if not name.getName().endswith(".crc"):
                out.append(str(name.toString()))
    return out


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return [str(f.getPath().toString()) for f in fs.listStatus(p) if f.isDirectory()]


# Work folders named by this process, in order.
_NAMED: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work root."""
    path = f"{work_root(spark)}/vigil-work/{name}-{uuid.uuid4().hex[:12]}"
    _NAMED.append(path)
    return path


def work_dirs() -> list[str]:
    """The work folders that this process has named so far."""
    return list(_NAMED)


def drop_work_dirs(spark: SparkSession, paths: list[str]) -> None:
    """Removes work folders of this process; call it once nothing reads them any more."""
    for path in paths:
        if path not in _NAMED:
            raise ValueError(f"{path} is not a work folder of this process")
        fs, p = _hadoop_path(spark, path)
        fs.delete(p, True)
