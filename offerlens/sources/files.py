"""Files: delimited tables, JSON documents, content hashes and manifests."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator, Mapping
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.contract import CSV_ENCODING, CSV_SEPARATOR
from offerlens.functions.scalars import DECIMAL_TEXT, col, null_tokens
from offerlens.operators.columns import clean_column_names, json_rows

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BEYOND = "__beyond_the_header"
PIECE = 1 << 20
STREAMED = frozenset({"file", "hdfs", "s3", "gs"})  # file systems that tasks can open themselves


def existing(spark: SparkSession, path: str, what: str = "input", hint: str = "") -> str:
    """``path`` if it exists on its file system, else ``FileNotFoundError``."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{what} not found: {path}. {hint}".strip()) from error
    return path


def read_text_table(spark: SparkSession, path: str, separator: str = CSV_SEPARATOR, multi_line: bool = False) -> DataFrame:
    """A delimited table with clean names, every column as text, missing tokens as NULL.

    A short row ends in missing cells; reading a row with more cells than the
    header is an error. Quoted line breaks need ``multi_line``, which reads
    each file in one task.
    """
    existing(spark, path, "delimited file")
    reader = (
        spark.read.option("sep", separator).option("header", True).option("encoding", CSV_ENCODING)
        .option("escape", '"').option("multiLine", multi_line)
    )
    header = reader.csv(path).schema
    raw = reader.schema(T.StructType([*header.fields, T.StructField(BEYOND, T.StringType())])).csv(path)
    fits = F.assert_true(col(BEYOND).isNull(), F.lit(f"{path} has a row with more than {len(header)} cells"))
    table = clean_column_names(raw.where(fits.isNull()).drop(BEYOND))
    return table.select(*[null_tokens(col(c)).alias(c) for c in table.columns])


def infer_types(table: DataFrame) -> dict[str, str]:
    """The narrowest type that holds each text column, found in one pass.

    Whole numbers without gaps are ``bigint``; other numbers, whole numbers
    with gaps and empty columns are ``double``; the rest stays ``string``.
    """
    def kind(name: str) -> Column:
        """What one cell could be, as a bit: gap, whole number, number, text.

        A failed cast raises inside the JVM, which is slow, so a pattern lets
        only plausible texts reach the casts.
        """
        cell = col(name)
        whole = cell.rlike(r"^\s*[+-]?\d{1,19}\s*$") & cell.try_cast("bigint").isNotNull()
        number = cell.rlike(DECIMAL_TEXT) & cell.try_cast("double").isNotNull()
        return F.when(cell.isNull(), 1).when(whole, 2).when(number, 4).otherwise(8)

    names = table.columns
    seen = table.agg(*[F.bit_or(kind(c)).alias(f"c{i}") for i, c in enumerate(names)]).first()
    found = [seen[f"c{i}"] or 0 for i in range(len(names))]
    return {c: "string" if bits & 8 else "bigint" if bits == 2 else "double" for c, bits in zip(names, found)}


def cast_columns(table: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast by name; text that does not fit becomes NULL; other columns stay."""
    return table.select(*[
        (col(c).try_cast(kinds[c]).alias(c) if c in kinds else col(c)) for c in table.columns
    ])


def read_delimited(
    spark: SparkSession,
    path: str,
    kinds: Mapping[str, str] | None = None,
    separator: str = CSV_SEPARATOR,
    multi_line: bool = False,
) -> DataFrame:
    """A delimited table with typed columns. Without ``kinds`` the types are inferred."""
    table = read_text_table(spark, path, separator, multi_line)
    return cast_columns(table, kinds or infer_types(table))


def write_delimited(df: DataFrame, path: str, separator: str = CSV_SEPARATOR) -> None:
    df.write.mode("overwrite").option("sep", separator).option("header", True).csv(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document per file as rows; a missing path gives no rows."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """Documents whose fields differ, one VARIANT ``document`` per JSON line of ``path`` or its subfolders; a missing path gives no rows.

    Numbers keep their digits and fields need no common schema. A line that is not JSON is an error.
    """
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value string")
    return lines.where(F.trim("value") != "").select(F.parse_json("value").alias("document"))


def variant_fields(df: DataFrame, column: str = "document", depth: int = 3) -> DataFrame:
    """The other columns with (field, value): a row per leaf of each document, ``field`` its path joined by dots.

    Members of a list are named by their position. A ``null`` has a row with a NULL value; an empty
    object or list, and what is nested deeper than ``depth``, has one with its JSON text. A document
    that is no object or list has no name and no row.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c != column]
    keep = [col(c) for c in others]
    level = df.select(F.struct(*keep).alias("_k"), F.lit("").alias("_path"), col(column).alias("_v"))
    leaves = []
    for at in range(depth):
        members = level.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(
            "_k", F.concat_ws(".", F.nullif("_path", F.lit("")), F.coalesce("key", F.col("pos").cast("string"))).alias("_path"), F.col("value").alias("_v"))
        nested = F.schema_of_variant("_v").rlike("^(OBJECT<.|ARRAY<)") & ~F.to_json("_v").isin("[]", "{}")
        last = at == depth - 1
        leaves.append(members if last else members.where(~F.coalesce(nested, F.lit(False))))
        level = members.where(nested)
    found = leaves[0]
    for more in leaves[1:]:
        found = found.unionByName(more)
    return found.select(*[F.col("_k").getField(c).alias(c) for c in others], F.col("_path").alias("field"),
                        F.variant_get("_v", "$", "string").alias("value"))


def write_document(df: DataFrame, path: str) -> None:
    """Rows as JSON lines with missing values written as ``null``."""
    json_rows(df, "value").write.mode("overwrite").text(path)


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file, and say whether this call has: of several writers at once exactly one is told so.

    Local files are created by the system's exclusive create, others by their file system's create without
    overwriting, which HDFS and stores with conditional writes do in one step.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    try:
        if system.getUri().getScheme() == "file":
            nio = jvm.java.nio.file
            nio.Files.createFile(nio.Path.of(target.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)),
                                 spark.sparkContext._gateway.new_array(nio.attribute.FileAttribute, 0))
        else:
            system.create(target, False).close()
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def _md5_of_stream(path: str) -> str:
    """MD5 of a file that is read in pieces, by a task."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        store, inside = pafs.LocalFileSystem(), f"/{rest.lstrip('/')}"
    else:
        store, inside = pafs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
    digest = hashlib.md5()
    with store.open_input_stream(inside) as stream:
        while piece := stream.read(PIECE):
            digest.update(piece)
    return digest.hexdigest()


def _with_digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(md5=[_md5_of_stream(p) for p in batch["path"]])


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and MD5 of the content of every file under ``path`` that is not empty.

    Files of any size are read by tasks in pieces of a megabyte. Where the tasks' reader does not know
    the file system, Spark reads the content, which it can for files of up to 2 GB.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    schemes = {r[0] for r in listed.select(F.substring_index("path", ":", 1)).distinct().collect()}
    if schemes <= STREAMED:
        names = listed.select("path", "length").repartition("path")
        return names.mapInPandas(_with_digest, "path string, length long, md5 string")
    return listed.select("path", "length", F.md5("content").alias("md5"))


def artifact_manifest(spark: SparkSession, path: str, wanted: Iterable[str], digest: bool = True) -> DataFrame:
    """Files, bytes and digest of the wanted artifacts that exist under ``path``.

    An artifact is an entry of the folder: a file, or what Spark writes, a folder
    of files. Its digest is the order-free sum of 60 bits of each file's MD5;
    without it no content is read, which suits large tables. Artifacts that are
    missing are left out.
    """
    name = F.substring_index(F.substring_index("path", f"{path.rstrip('/')}/", -1), "/", 1)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    known = file_manifest(spark, path) if digest else listed
    found = known.withColumn("name", name).where(F.col("name").isin(*wanted)).groupBy("name")
    facts = [F.count("*").alias("files"), F.sum("length").alias("bytes")]
    if digest:
        bits = F.conv(F.substring("md5", 1, 15), 16, 10).cast("decimal(20,0)")
        facts.append(F.sum(bits).cast("string").alias("digest"))
    return found.agg(*facts)


def content_md5(spark: SparkSession, path: str) -> Column:
    """MD5 of a file, or of the sorted MD5s of the files of a folder, as a one-row value."""
    listed = file_manifest(spark, path).agg(F.sort_array(F.collect_list("md5")).alias("all"))
    return listed.select(F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(F.md5(F.array_join("all", "")))).scalar()


def table_fingerprint(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Row count and an order-free digest of all rows, from a plain aggregate.

    Each row hashes to 60 bits and the hashes are summed, so the order of rows
    and the number of partitions do not matter. A cell enters with its length, so
    no two rows read alike. Doubles enter exactly, or as whole numbers of
    ``digits`` decimals. Unlike a file hash this reads the table in parallel.
    """
    texts = []
    for field in df.schema.fields:
        value = col(field.name)
        if digits is not None and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            small = F.abs(value) < 9e18 / 10**digits
            value = F.when(small, F.rint(value * 10**digits).cast("bigint").cast("string")).otherwise(value.cast("string"))
        text = value.cast("string")
        texts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    digest = F.md5(F.concat(*texts))
    bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("fingerprint"),
    )
