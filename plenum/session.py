"""Session construction and cluster-safe lineage cutting.

The library never creates a session on its own inside an operator; callers
pass one in. ``get_session`` is the convenience used by tests, the bench and
the entry module.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (this is
# the size check behind every join that is not explicitly hinted), coalesces
# small shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "plenum") -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PLENUM_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    On a cluster the setting names a shared folder (HDFS/S3/ABFS) so a lost
    executor does not lose checkpointed data. Only local runs (tests) fall
    back to a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = fallback or os.environ.get("PLENUM_CHECKPOINT_DIR")
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would vanish with its executor
            raise RuntimeError("spark.checkpoint.dir must name a shared folder (HDFS/S3/ABFS) on a cluster")
        import tempfile

        configured = tempfile.mkdtemp(prefix="plenum-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``plenum`` importable on the Python workers (the programmatic
    form of ``--py-files plenum.zip``): the package is zipped once and added
    to the SparkContext, which distributes it to every executor. Needed by the
    Arrow UDFs and ``mapInPandas`` steps, which reference package functions."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import tempfile
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="plenum-pyfiles-"), "plenum.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
