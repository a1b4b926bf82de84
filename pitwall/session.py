"""Session settings the plans rely on."""

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give executors this package, once per application, for functions that run in Python workers."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        # Executors fetch the archive from the driver when they first need it.
        folder = tempfile.mkdtemp(prefix="pitwall-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = os.path.join(folder, os.path.basename(package))
        archive = shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark

# Runtime settings: let Spark re-plan from measured sizes, split skewed join
# partitions even where that costs one more shuffle, and prune by join keys.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Stored input per shuffle partition.
BYTES_PER_PARTITION = 128 * 1024 * 1024
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_sized: dict[str, tuple[str, str]] = {}


def sized_for(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Set the number of shuffle partitions to what the input needs, so that each fits in memory.

    Never below the session's own setting, which holds again for the next, smaller input.
    Spark merges partitions that turn out small at run time.
    """
    app, now = spark.sparkContext.applicationId, spark.conf.get(_SHUFFLE_PARTITIONS)
    own, last = _sized.get(app, (now, now))
    own = own if now == last else now
    wanted = str(max(int(own), input_bytes // BYTES_PER_PARTITION + 1))
    spark.conf.set(_SHUFFLE_PARTITIONS, wanted)
    _sized[app] = own, wanted
    return spark


def local_session(name: str, cores: str = "8", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)
