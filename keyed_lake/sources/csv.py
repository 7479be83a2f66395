"""CSV folders as streams of all-text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyed_lake.spec import TableSpec
from keyed_lake.storage import Files

ARCHIVE_FOLDER = "_archive"
CORRUPT = "_corrupt"  # the whole line, where its number of fields is not that of the spec
MAX_AGE = "366d"
CLEANER_THREADS = "spark.sql.streaming.fileSource.cleaner.numThreads"


def csv_stream(
    spark: SparkSession,
    spec: TableSpec,
    csv_root: str,
    archive: bool = True,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
    corrupt: bool = False,
) -> DataFrame:
    """The header-less CSV files under the spec's folder, subfolders included, all fields as text.

    `options` are Spark CSV options, such as another quote or escape character.
    With `corrupt`, a column `_corrupt` holds lines with too many or too few fields, which are cut or filled otherwise.
    Spark remembers the name of a file for a year, by file times; older files than the newest by more are passed over.
    With `archive`, Spark moves a file to `<csv_root>/_archive` some time after the batch that read it is done.
    """
    root = csv_root.rstrip("/")
    reader = (
        spark.readStream.schema(T.StructType([*spec.text_schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", MAX_AGE)  # a file copied in late with an old time must not be passed over
    )
    if archive:
        Files(spark).mkdirs(f"{root}/{ARCHIVE_FOLDER}")
        spark.conf.set(CLEANER_THREADS, "3")
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", f"{root}/{ARCHIVE_FOLDER}")
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(f"{root}/{spec.csv_folder}")
    return rows if corrupt else rows.drop(CORRUPT)


def has_csv_folder(spark: SparkSession, spec: TableSpec, csv_root: str) -> bool:
    return Files(spark).is_folder(f"{csv_root.rstrip('/')}/{spec.csv_folder}")
