"""Small file-system helpers on the session's Hadoop configuration; they move names, never rows."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark import SparkContext
from pyspark.sql import SparkSession


class Files:
    """Folder operations that work on any URI Spark can read."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs(path).getFileStatus(self._path(path)).isDirectory()

    def mkdirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names directly under a folder, sorted; empty when the folder is absent."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(self._path(path)))

    def data_files(self, spark: SparkSession, folders: list[str]) -> list[str]:
        """The data files below folders, as Spark lists them: many folders by tasks."""
        found = spark.read.schema("_ int").parquet(*folders).inputFiles()
        return [unquote(f) for f in found]

    def size(self, path: str) -> int:
        """Bytes of all files below a folder."""
        return self._fs(path).getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_folder(self, source: str, target: str) -> None:
        """Put a folder in the place of another one."""
        self.delete(target)
        self.publish_folder(source, target)

    def publish_folder(self, staged: str, final: str) -> None:
        """Rename a finished folder into place; one step on HDFS and local disks, not on object stores."""
        self.mkdirs(final.rsplit("/", 1)[0])
        if not self._fs(staged).rename(self._path(staged), self._path(final)):
            raise IOError(f"can't publish {staged} as {final}")

    def publish_text(self, path: str, text: str, replace: bool = False) -> None:
        """Create a text file in one step (on file systems that rename in one step).

        Raises if it is there already, unless it may be replaced.
        """
        folder, name = path.rsplit("/", 1)
        self.mkdirs(folder)
        staged = f"{folder}/.{name}.{uuid.uuid4().hex}"
        stream = self._fs(staged).create(self._path(staged), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs(path).getUri(), self._conf
        )
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        mode = SparkContext._gateway.new_array(rename, 1)
        mode[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            context.rename(
                context.makeQualified(self._path(staged)), context.makeQualified(self._path(path)), mode
            )
        except Exception:
            self.delete(staged)
            raise


#: URI schemes of object stores whose rename copies object by object.
NO_RENAME = ("s3", "s3a", "s3n", "gs", "oss", "cosn", "obs", "swift", "wasb", "wasbs")


def needs_rename(path: str) -> None:
    """Refuse a path on an object store without a rename in one step; appends and overwrites end with one."""
    scheme = path.split("://", 1)[0].lower() if "://" in path else ""
    if scheme in NO_RENAME:
        raise ValueError(f"{scheme}:// has no rename in one step; keep logs in Kafka and tables in Delta there")


def object_store_settings(path: str) -> dict[str, str]:
    """Session settings for writing plain Parquet (scratch tables, exports) to a store: how a job commits its files.

    `s3a` uploads parts and completes them at commit, without a rename; `abfs` and `gs` rename file by file under a
    manifest. Other file systems need nothing. The classes are those of Spark's cloud module, which must be installed.
    """
    scheme = path.split("://", 1)[0].lower() if "://" in path else ""
    if scheme not in ("s3a", "abfs", "abfss", "gs"):
        return {}
    settings = {
        "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
        "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
    }
    factory = "org.apache.hadoop.mapreduce.lib.output.committer.manifest.ManifestCommitterFactory"
    if scheme == "s3a":
        factory = "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory"
        settings["spark.hadoop.fs.s3a.committer.name"] = "magic"
    return settings | {f"spark.hadoop.mapreduce.outputcommitter.factory.scheme.{scheme}": factory}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, under the shared folder in `spark.checkpoint.dir`.

    A machine-local folder is used only for a local master with that setting absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="keyed-lake-")
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    Files(spark).mkdirs(folder)
    return folder
