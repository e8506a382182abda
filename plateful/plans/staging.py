"""Written intermediate tables.

A table that several later steps read can be computed once and written to the shared
checkpoint folder. Later steps then start from the written rows, and a lost executor costs
a file read instead of the whole upstream job.
"""

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables: ``spark.checkpoint.dir``.

    Where that is unset and all executors are on this machine, a folder in the warehouse is used. On a cluster
    the warehouse may be a folder of the driver alone, so the setting is needed there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, with its lineage cut.

    Spark removes the files itself when the table is no longer referenced, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, path: str, *by: str) -> DataFrame:
    """``df`` computed once and written to the new folder ``path``, split by the columns ``by``; the caller removes it.

    Unlike a checkpoint the rows are compressed and read by column, and those of one value of ``by`` alone.
    """
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folders(spark: SparkSession, path: str, files: bool = False) -> list[str]:
    """Names of the folders (or of the files) in a folder of any file system that Spark reads; empty if it is missing."""
    files_of, where = _file_system(spark, path)
    if not files_of.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files_of.listStatus(where) if s.isDirectory() != files)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    files_of, where = _file_system(spark, path)
    files_of.delete(where, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to a place that is free."""
    files_of, where = _file_system(spark, path)
    target = _file_system(spark, to)[1]
    files_of.mkdirs(target.getParent())
    if files_of.exists(target) or not files_of.rename(where, target):
        raise OSError(f"could not move {path} to {to}")


def exists(spark: SparkSession, path: str) -> bool:
    files_of, where = _file_system(spark, path)
    return files_of.exists(where)


def _file_system(spark, path):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def lazy(df: DataFrame) -> DataFrame:
    """Keep ``df`` as a plan; Spark recomputes it for each use it cannot share."""
    return df
