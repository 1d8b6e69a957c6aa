"""Steps written to the folder that ``spark.checkpoint.dir`` names, and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardlake.sources.storage import new_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table: lineage is cut and later readers share one computation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the folder of a stored step that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
