"""Sources: delimited files, folders of them, nested JSON payloads, provenance."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions import defaults as d
from wardlake.sources.files import can_open, digests, first_records, listed
from wardlake.sources.records import charset, read_records


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    position: str | None = None,
    multiline: bool = False,
    null_markers: Sequence[str] = d.NULL_MARKERS,
) -> DataFrame:
    """Delimited text with a header, every column as text; a byte-order mark is tolerated.

    Quotes are doubled inside quoted values, and the usual markers of a missing value are
    null. All files must have the same header; ``read_delimited_dir`` takes mixed ones. With
    ``position``, adds a column that orders rows as they stand in the files: path, start of
    the split, place within the split. Values that hold line breaks need ``multiline``: such
    files are split as well, at the price of a first pass over them (``records.py``), unless
    their encoding is none in which a line break can be seen; then a file is one task.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    options = {"header": True, "sep": sep, "encoding": encoding, "quote": '"', "escape": '"'}
    if multiline and charset(encoding):
        names = spark.read.csv(listed, multiLine=True, **options).columns
        df = read_records(spark, listed, names, sep, encoding)
        columns = [_null_if(name, null_markers).alias(name) for name in names]
        return df.select(*columns, F.col("_place").alias(position)) if position else df.select(*columns)
    df = spark.read.csv(listed, multiLine=multiline, **options)
    columns = [_null_if(name, null_markers).alias(name) for name in df.columns]
    if not position:
        return df.select(*columns)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select(*columns, place.alias(position))


def _null_if(name: str, markers: Sequence[str]) -> Column:
    value = F.col(f"`{name}`")
    return F.when(~value.isin(*markers), value) if markers else value


def read_delimited_dir(
    spark: SparkSession,
    pattern: str,
    sep: str = ";",
    encoding: str = "UTF-8",
    fallback: Callable[[], DataFrame] | None = None,
    multiline: bool = False,
    null_markers: Sequence[str] = d.NULL_MARKERS,
) -> DataFrame:
    """All files that match, aligned by column name; missing columns are null.

    One multi-file read takes the header of one file for all and would swap columns where
    others order them differently. So files are read together only with files of the same
    header: the plan has one scan per distinct header, not per file.
    """
    try:
        files = listed(spark, pattern)
        example = files.select("path").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        example = None
    if example is None:
        if fallback is not None:
            return fallback()
        raise FileNotFoundError(f"no file matches {pattern}")

    headers = first_records(files, encoding) if can_open(example.path) else read_first_lines(spark, pattern, encoding)
    parts = [
        read_delimited(spark, group, sep, encoding, multiline=multiline, null_markers=null_markers)
        for group in header_groups(headers)
    ]
    if not parts:
        raise ValueError(f"no file of {pattern} has a header")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def header_groups(headers: DataFrame) -> list[list[str]]:
    """The files of each distinct header, from one row (file, header) per file; files without
    lines are left out. Names of files are all that comes to the driver, where Spark's reader
    wants them; no task gathers those of one header."""
    groups: dict[str, list[str]] = {}
    for row in headers.where("header IS NOT NULL").select("file", F.md5("header").alias("header")).collect():
        groups.setdefault(row.header, []).append(row.file)
    return sorted(sorted(group) for group in groups.values())


def read_first_lines(spark: SparkSession, pattern: str, encoding: str) -> DataFrame:
    """The same rows through Spark's reader, for file systems that only Spark can open; it
    reads the files whole.

    Lines are taken whole (no separator and no quote occurs in them), so that this works for
    any number of columns.
    """
    lines = spark.read.schema("line string").csv(
        pattern, sep="\u0001", quote="", encoding=encoding,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    starts = lines.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), "line", F.monotonically_increasing_id().alias("at")
    )
    return starts.groupBy("file").agg(F.min_by("line", "at").alias("header"))


def first_available(sources: Sequence[tuple[str, Callable[[], DataFrame]]]) -> tuple[str, DataFrame]:
    """Name and frame of the first source that exists and has rows, in the caller's order.

    Only a missing path counts as absent; any other failure is raised.
    """
    for name, read in sources:
        try:
            df = read()
            if not df.isEmpty():
                return name, df
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        except FileNotFoundError:
            pass
    raise FileNotFoundError("no source has rows: " + ", ".join(name for name, _ in sources))


_COMMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("like_count", T.LongType()),
    ]
)
_COMMENT_PAGE = T.StructType([T.StructField("data", T.ArrayType(_COMMENT))])
_POST = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("comments", _COMMENT_PAGE)]
)
#: One landed response per line: posts, each with the comments fetched for it.
PAYLOAD_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(_POST))])


def read_payloads(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Landed responses, one per line, or one per file with ``multiline``. A response that is
    not JSON is an error; one without ``data`` has no posts."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path, mode="FAILFAST", multiLine=multiline)


def flatten_comments(payloads: DataFrame, max_posts: int | None = None) -> DataFrame:
    """One row per comment of all posts of each response, or of its first ``max_posts``.

    A post whose comments could not be fetched has none in the payload and gives no row.
    Nothing is shuffled: both arrays unfold where they are read.
    """
    posts = F.col("data") if max_posts is None else F.slice("data", 1, max_posts)
    post = payloads.select(F.explode(posts).alias("post"))
    comment = post.select(
        F.col("post.id").alias("post_id"), F.explode("post.comments.data").alias("c")
    )
    return comment.select(
        F.col("c.id").alias("comment_id"),
        "post_id",
        F.coalesce("c.username", F.lit("")).alias("autor"),
        F.substring(F.coalesce("c.timestamp", F.lit("")), 1, 10).alias("data_comentario"),
        F.coalesce("c.like_count", F.lit(0)).alias("curtidas"),
        F.coalesce("c.text", F.lit("")).alias("texto_comentario"),
    )


def provenance(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Per file: ingest time, source, MD5 of its bytes, size and number of rows.

    ``rows`` is the frame read from the same path. A file of any size is hashed as a stream. On
    a file system that only Spark can open it is hashed from one value, and must stay below 2 GB.
    """
    files = listed(spark, path)
    example = files.select("path").first()
    if example is None or can_open(example.path):
        hashed = digests(files)
    else:
        whole = spark.read.format("binaryFile").load(path)
        hashed = whole.select(
            F.col("_metadata.file_path").alias("file"), F.col("length").alias("n_bytes"), F.md5("content").alias("file_hash")
        )
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    return hashed.join(counted, "file", "left").select(
        F.current_timestamp().alias("ingested_at"),
        F.col("file").alias("source"),
        "file_hash",
        "n_bytes",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
