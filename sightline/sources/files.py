"""CSV and bullet-list sources, CSV and progress sinks."""

from __future__ import annotations

import codecs
import csv
import io
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import squeeze
from ..operators.ranking import numbered

ENCODINGS = ("utf-8-sig", "cp949", "utf-8")
#: Characters that may stand before a row of a CSV file without being part of a value (fixed value).
BOM = "﻿"


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """A CSV table of strings, with quoted newlines; empty cells are empty strings; a byte-order mark is dropped."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding=encoding)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def decode(raw: bytes, encodings: tuple = ENCODINGS) -> str:
    """The text under the first encoding that fits; bytes that fit none are replaced."""
    for encoding in encodings:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode(encodings[-1], "replace")


def read_csv_any(spark: SparkSession, path: str, encodings: tuple = ENCODINGS) -> DataFrame:
    """CSV files whose encoding is found file by file: the columns of the first file's header, and
    ``source_row``, the 1-based row, by file and row.  Rows stream out of each file; a file is one task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    head = files.orderBy("path").select(F.substring("content", 1, 1 << 16)).first()
    names = next(csv.reader(io.StringIO(_lenient(bytes(head[0]), encodings))), []) if head else []
    names = [n.removeprefix(BOM) for n in names]
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("source_row", T.LongType()), T.StructField("__file", T.StringType())])

    def rows(batches):
        for batch in batches:
            for path_, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = csv.DictReader(io.StringIO(decode(raw, encodings), newline=""))
                some: list[list] = []
                for i, row in enumerate(reader, 1):
                    some.append([*[row.get(n) or "" for n in names], i])
                    if len(some) == 10_000:
                        yield _batch(some, names, path_)
                        some = []
                if some:
                    yield _batch(some, names, path_)

    out = files.mapInArrow(rows, schema)
    if files.select("path").limit(2).count() > 1:
        out = numbered(out.withColumnRenamed("source_row", "__row"), [F.col("__file"), F.col("__row")], "source_row").drop("__row")
    return out.select(*[F.col("`" + n.replace("`", "``") + "`") for n in names], "source_row")


def _lenient(raw: bytes, encodings: tuple) -> str:
    """The beginning of a file, whose last character may be cut."""
    for encoding in encodings:
        try:
            return codecs.getincrementaldecoder(encoding)().decode(raw)
        except UnicodeDecodeError:
            continue
    return raw.decode(encodings[-1], "replace")


def _batch(rows: list[list], names: list[str], path: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in columns[:-1]], pa.array(columns[-1], pa.int64()), pa.array([path] * len(rows), pa.string())], [*names, "source_row", "__file"])


def read_bullets(spark: SparkSession, path: str, label: str = "item") -> DataFrame:
    """(position, value): the bullets of a Markdown list, distinct in order.  None at all is an error."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    found = F.regexp_extract("line", r"^\s*[-*]\s+(.+?)\s*$", 1)
    rows = lines.select("at", found.alias("value")).filter("value <> ''").groupBy("value").agg(F.min("at").alias("at"))
    out = rows.selectExpr("cast(row_number() over (order by at) as int) as position", "value")
    if out.isEmpty():
        raise ValueError(f"no {label} in {path}")
    return out


def write_csv(df: DataFrame, path: str, columns: tuple | list) -> None:
    """A CSV folder of the columns in order, replaced as a whole when the job commits."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def export_csv(df: DataFrame, path: str, columns: tuple | list) -> int:
    """One CSV file with a byte-order mark, at a path of any file system, written piece by piece on the driver
    and put in place of an earlier one at the end.  Other columns are left out."""
    context, n, text = df.sparkSession.sparkContext, 0, io.StringIO(newline="")
    path_of = context._jvm.org.apache.hadoop.fs.Path
    part, place = path_of(f"{path}.tmp"), path_of(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    out, rows = system.create(part, True), csv.writer(text)
    text.write(BOM)
    rows.writerow(columns)
    for row in df.select(*columns).toLocalIterator():
        rows.writerow(["" if x is None else x for x in row])
        n += 1
        if text.tell() > 1 << 20:
            out.write(bytearray(text.getvalue().encode()))
            text.seek(0)
            text.truncate()
    out.write(bytearray(text.getvalue().encode()))
    out.close()
    system.delete(place, False)
    system.rename(part, place)
    return n


def append_csv(df: DataFrame, path: str, columns: tuple | list) -> int:
    """Rows added to one CSV file, row by row on the driver; a new or empty file begins with a byte-order mark
    and the header."""
    fresh, n = not os.path.exists(path) or os.path.getsize(path) == 0, 0
    with open(path, "a", encoding="utf-8-sig" if fresh else "utf-8", newline="") as f:
        out = csv.writer(f)
        if fresh:
            out.writerow(columns)
        for row in df.select(*columns).toLocalIterator():
            out.writerow(["" if x is None else x for x in row])
            n += 1
    return n


def append(df: DataFrame, path: str, columns: tuple | list) -> None:
    df.select(*columns).write.mode("append").parquet(path)


PROGRESS = "last_processed_index long, next_start_index long, total long, saved_rows long, saved_failures long, updated_at string"


def write_progress(spark: SparkSession, path: str, last: int, total: int, saved: int, failures: int = 0) -> None:
    """One JSON row: where a run is, and how many rows and failures it has saved."""
    row = spark.createDataFrame([(last, min(total + 1, last + 1), total, saved, failures)], ", ".join(PROGRESS.split(", ")[:-1]))
    row.withColumn("updated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).coalesce(1).write.mode("overwrite").json(path)


def put(spark: SparkSession, path: str, raw: bytes) -> None:
    """A small file, at a path of any file system that Spark can write."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(raw))
    out.close()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path of any file system that Spark can read."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def read_progress(spark: SparkSession, path: str) -> dict:
    """The last progress; nothing, or what can't be read, is an empty one."""
    row = spark.read.schema(PROGRESS).json(path).first() if exists(spark, path) else None
    return row.asDict() if row and row["next_start_index"] is not None else {}


def list_pages(rows: DataFrame, column: str = "list_url", position: str = "source_row") -> DataFrame:
    """Rows with a list URL, squeezed, and their 1-based number among those, by position."""
    return numbered(rows.withColumn("list_url", squeeze(column)).filter("list_url <> ''"), [F.col(position)], "page_index")


def dotenv(path: str, environment: dict | None = None) -> dict:
    """KEY=value lines, quotes stripped; blank lines, # lines and lines without = are left out, and what the
    environment has stays."""
    out = dict(os.environ if environment is None else environment)
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and key and not key.startswith("#"):
                    out.setdefault(key.strip(), value.strip().strip("\"'"))
    return out


def data_dir(given: str, environment: dict, key: str = "DATA_DIR", default: str = "data") -> str:
    """Where data files stand: what the caller gives, the environment, a default; without a slash at the end."""
    return (given or environment.get(key, "") or default).rstrip("/") or "/"


def data_path(path: str, folder: str) -> str:
    """A path as it is if it is absolute or names a file system, else below the data folder."""
    return path if path.startswith("/") or "://" in path else f"{folder}/{path}"


def credential(given: str, constant: str, environment: dict, key: str) -> str:
    """The first that isn't empty: what the caller gives, a constant, the environment."""
    return given or constant or environment.get(key, "")
