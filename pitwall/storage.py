"""Shared folders: scratch space, reliable checkpoints, published table versions."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}


def shared_base(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without it; a cluster without one is an error,
    because a folder on one machine is lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="pitwall-")
    return _local_base[app]


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A folder name of its own below the shared one; a new one on every call."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and cut the lineage there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of everything below a folder; zero if there is none."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def folder_names(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Values v of the folders ``root/<prefix>v``, sorted."""
    fs, hadoop_path = _file_system(spark, root)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted(name[len(prefix):] for name in names if name.startswith(prefix))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is any file below a folder."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path) and fs.listFiles(hadoop_path, True).hasNext()


def finished_folders(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Values v of the folders ``root/<prefix>v`` whose write was committed, sorted."""
    return [v for v in folder_names(spark, root, prefix) if exists(spark, f"{root}/{prefix}{v}/_SUCCESS")]


def write_version(df: DataFrame, table_root: str, version: int) -> str:
    """Write one full version of a table beside the older ones; it is an error if it is there already."""
    path = f"{table_root}/v={version:012d}"
    df.write.mode("error").parquet(path)
    return path


def current_version(spark: SparkSession, table_root: str) -> int | None:
    """The newest committed version."""
    versions = [int(v) for v in finished_folders(spark, table_root, "v=")]
    return versions[-1] if versions else None


def next_version(spark: SparkSession, table_root: str) -> int:
    """A number above all versions, finished or not, so that no writer meets the folder of another."""
    fs, hadoop_path = _file_system(spark, table_root)
    if not fs.exists(hadoop_path):
        return 1
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return max([0, *(int(name.removeprefix("v=")) for name in names if name.startswith("v="))]) + 1


def read_version(spark: SparkSession, table_root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{table_root}/v={version:012d}")


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def drop_old_versions(spark: SparkSession, table_root: str, keep: int) -> None:
    """Remove finished versions but the newest so many; readers of those that go must have ended."""
    for version in finished_folders(spark, table_root, "v=")[:-keep]:
        delete_folder(spark, f"{table_root}/v={version}")
