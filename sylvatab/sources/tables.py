"""Text and CSV tables in and out."""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvatab.operators.sets import union_by_name

MISSING = "NA"


def scratch_root(spark: SparkSession) -> str:
    """The folder of this run's shared results: below ``spark.checkpoint.dir``,
    or below the warehouse where that is unset and the session runs on one
    machine. Each application has its own, so that ``clear_scratch`` takes
    nothing from others."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{folder.rstrip('/')}/sylvatab-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one shared result."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every shared result this application wrote; results that read
    them can't be computed again."""
    for table in spark.catalog.listTables():
        if table.name.startswith("shared_"):
            spark.sql(f"DROP TABLE {table.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several results need to the shared folder and read it
    back: it is computed once, survives lost executors, and the reader knows
    its size, so that Spark broadcasts it only when it is small."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, by: list[str] | None = None) -> DataFrame:
    """Write a table that several joins look up by ``key`` to the shared folder, in
    as many buckets as a shuffle has partitions, and read it back: the joins
    shuffle the other side to it and leave it where it is. ``by`` are columns that
    readers filter on, each value a folder of its own."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"shared_{uuid.uuid4().hex}"
    writer = df.repartition(parts, key).write.bucketBy(parts, key).sortBy(key)
    if by:
        writer = writer.partitionBy(*by)
    writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def _headers(lines: DataFrame, is_header: Callable[[str], bool]) -> dict[str, str]:
    """The header of each file of ``lines`` (``file`` and ``value``): the first line
    that is one, empty where there is none.

    Each file is one partition in a session of its own, and its task stops at the
    header, so that no more than the start of a file is read. One row for each
    file comes to the driver.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, header = None, ""
        for batch in batches:
            file = file or (batch.column(0)[0].as_py() if batch.num_rows else None)
            header = next((v for v in batch.column(1).to_pylist() if is_header(v)), "")
            if header:
                break
        if file:
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([header])], names=["file", "header"])

    # Files are named as addresses, with signs such as the space written as numbers.
    return {unquote(r["file"]): r["header"] for r in lines.mapInArrow(first, "file string, header string").collect()}


def _whole_files(spark: SparkSession) -> SparkSession:
    """A session that reads every file as one partition, in small batches."""
    probe = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        probe.conf.set(f"spark.sql.files.{name}", str(1 << 40))
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    return probe


def _by_header(headers: dict[str, tuple[str, ...]]) -> dict[tuple[str, ...], list[str]]:
    """Files of each header."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file, header in sorted(headers.items()):
        found.setdefault(header, []).append(file)
    return found


TOKEN = r'"[^"]*"|\S+'


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Whitespace-delimited text with a header line and optional double quotes.

    Columns are found by the header of the file a line stands in, in any order,
    so files may differ in it; a header is a line that names every column of the
    schema. ``NA`` is missing. A value that is not of its column's type is an
    error, and so is a file without a header. Headers are looked up first, and
    files of one header are read together: places of columns are constants, and
    nothing is joined or shuffled.
    """
    wanted = set(schema.fieldNames())

    def split(line: str) -> list[str]:
        return [t.strip('"') for t in re.findall(TOKEN, line)]

    lines = _whole_files(spark).read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    headers = _headers(lines, lambda line: wanted <= set(split(line)))
    without = sorted(file for file, header in headers.items() if not header)
    if without:
        raise ValueError(f"columns missing from the header of {', '.join(without)}")
    groups = _by_header({file: tuple(split(header)) for file, header in headers.items()})
    tables = [
        _read_lines(spark.read.text(path if len(groups) == 1 else files), list(header), schema)
        for header, files in groups.items()
    ]
    return union_by_name(*tables) if tables else spark.createDataFrame([], schema)


def _read_lines(lines: DataFrame, header: list[str], schema: T.StructType) -> DataFrame:
    """The rows of text files that all have this header."""
    tokens = F.transform(
        F.regexp_extract_all("value", F.lit(TOKEN), F.lit(0)), lambda t: F.regexp_replace(t, '^"|"$', "")
    )
    # As a generator's row: a filter on the tokens is not moved below it, where
    # it would find them anew for each column.
    texts = lines.select(F.explode(F.array(tokens)).alias("t")).filter(F.size("t") > 0)
    places = {f.name: header.index(f.name) for f in schema}
    heading = reduce(lambda x, y: x & y, [F.get("t", F.lit(p)).eqNullSafe(F.lit(c)) for c, p in places.items()])

    def text(field: T.StructField) -> Column:
        return F.nullif(F.get("t", F.lit(places[field.name])), F.lit(MISSING))

    def fault(field: T.StructField) -> Column:
        message = F.concat(F.lit(f"{field.name}: "), text(field), F.lit(f" is no {field.dataType.simpleString()}"))
        return F.when(text(field).isNotNull() & text(field).try_cast(field.dataType).isNull(), message)

    faults = F.concat_ws("; ", *[fault(f) for f in schema if f.dataType != T.StringType()], F.lit(None).cast("string"))
    rows = texts.filter(~heading)
    sound = rows.filter(F.when(faults == "", True).otherwise(F.raise_error(faults).cast("boolean")))
    return sound.select(*[text(f).try_cast(f.dataType).alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, lines_in_fields: bool = False) -> DataFrame:
    """CSV with a header; a quote inside a quoted field is doubled. Fields that
    hold line ends need ``lines_in_fields``, which reads each file in one task."""
    return spark.read.csv(path, header=True, schema=schema, nullValue=MISSING, escape='"', multiLine=lines_in_fields)


def read_csv_set(
    spark: SparkSession, directory: str, include: str, exclude: str | None, schema: T.StructType
) -> DataFrame:
    """All tables of a directory whose name matches ``include`` and not
    ``exclude``, stacked by column name.

    ``schema`` types the columns; a table may lack some of them, and columns it
    does not name are kept as text. A table is a file or a folder of part files;
    each file is read by its own header. Names are looked at in the listing of the
    folder, so no other file is opened; of the wanted ones the headers are read
    first, and files of one header together.
    """
    folder = re.escape(directory.rstrip("/").split("/")[-1])
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/{folder}/([^/]+)", 1)
    lines = _whole_files(spark).read.option("recursiveFileLookup", "true").text(directory).filter(name.rlike(include))
    if exclude is not None:
        lines = lines.filter(~name.rlike(exclude))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value")
    headers = _headers(lines, lambda line: True)
    groups = _by_header({file: tuple(next(csv.reader([line]))) for file, line in headers.items() if line})
    if not groups:
        raise FileNotFoundError(f"no table in {directory} matches {include!r}")
    types = {f.name: f for f in schema}
    tables = [
        read_csv(spark, paths, T.StructType([types.get(c, T.StructField(c, T.StringType())) for c in columns]))
        for columns, paths in groups.items()
    ]
    return union_by_name(*tables)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def write_csv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """CSV with header and ``NA``; with ``by`` one folder per value. What was there
    is replaced.

    The rebalance hint lets the adaptive planner split a large folder into
    several files and merge small ones.
    """
    if by:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in by])
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.csv(path, header=True, nullValue=MISSING, escape='"')


def write_sites(df: DataFrame, path: str, sites: list[str], by: list[str], site: str = "site") -> str:
    """Replace these sites' folders by the sites' rows in ``df`` and leave all other
    sites as they are; gives the run's number.

    Rows go to a folder beside the old ones and are moved when all are written, so
    a run that fails leaves the old site. After that, folders of these sites that
    the run has no rows for go, and the run is listed in ``_runs`` (site and run): a
    site whose last run is not there is as it was before.
    """
    spark = df.sparkSession
    before = _files_of(spark, path, site, sites)
    own = df.filter(F.col(f"`{site}`").isin(sites)).hint("rebalance", *[F.col(f"`{c}`") for c in by])
    writer = own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.csv(path, header=True, nullValue=MISSING, escape='"')
    after = _files_of(spark, path, site, sites)
    for folder, files in before.items():
        if after.get(folder) == files:
            _remove(spark, folder)
    run = uuid.uuid4().hex
    listed = spark.createDataFrame([(s, run) for s in sites], "site string, run string")
    listed.coalesce(1).write.mode("append").json(f"{path}/_runs")
    return run


def _files_of(spark: SparkSession, path: str, site: str, sites: list[str]) -> dict[str, set[str]]:
    """Data files of each folder of these sites."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, set[str]] = {}
    if not system.exists(top):
        return found
    wanted = {f"{site}={_escaped(spark, s)}" for s in sites}
    files = system.listFiles(top, True)
    while files.hasNext():
        file = files.next().getPath()
        folder = file.getParent().toString()
        if wanted & set(folder.split("/")) and not file.getName().startswith((".", "_")):
            found.setdefault(folder, set()).add(file.getName())
    return found


def _escaped(spark: SparkSession, value: str) -> str:
    """A value as it is spelled in the name of a folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_split(
    df: DataFrame, path: str, outcome: str = "outcome", site: str = "site", sites: list[str] | None = None
) -> None:
    """Resolved and unresolved rows of one table, in one pass over it: all sites,
    or these sites anew beside the others."""
    if sites is None:
        write_csv(df, path, by=[outcome, site])
    else:
        write_sites(df, path, sites, [outcome, site], site)


def data_dictionary(df: DataFrame, meanings: dict[str, str]) -> DataFrame:
    """Name and meaning of each column; a column comment is the fallback."""
    rows = [(f.name, meanings.get(f.name, f.metadata.get("comment"))) for f in df.schema]
    return literal_table(df.sparkSession, rows, "variable string, meaning string")


def completeness(df: DataFrame) -> DataFrame:
    """Number of values present in each column, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    pairs = [
        F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").alias("n_present"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*pairs)))
