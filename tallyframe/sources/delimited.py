"""Delimited-text scans and report sinks.

Results files are ``;``-separated, Latin-1, with a header.  Without a declared
schema every column is read as text, by the names in each file's own header,
and typed afterwards; ``infer_schema`` (a full extra pass over the input) exists
only to profile a new file once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyframe.operators.clean import clean_headers, string_columns

# What a quoted empty text is read as before it becomes "" again: a text no report holds.
_EMPTY_MARK = "\x00"
# Files whose first lines are read at a time.
HEADER_THREADS = 32
# Encodings that can't hold every character and that ``encode`` knows.
_NARROW = ("ISO-8859-1", "US-ASCII")


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None, *,
                   sep: str = ";", encoding: str = "ISO-8859-1", header: bool = True,
                   mode: str = "PERMISSIVE", clean_names: bool = True,
                   infer_schema: bool = False) -> DataFrame:
    """Scan delimited files (a file, a folder or a glob).

    With a declared ``schema`` the header row only has to be present; columns
    are taken by position and named by the schema.  Without one, header names
    are cleaned by the results-file rule (``clean_headers``), and files of one
    folder may list their columns in different orders: columns go by name, and
    files that do not have the same columns raise ``ValueError``.  That takes
    a small read of every file's first line on the driver, and no Spark job per file.  ``mode`` is Spark's CSV mode:
    PERMISSIVE (bad fields become null), DROPMALFORMED or FAILFAST.
    """
    reader = (spark.read.option("sep", sep).option("encoding", encoding)
              .option("header", str(header).lower()).option("mode", mode))
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "true")
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    if schema is not None or not header:
        return reader.csv(path) if schema is not None else _named(reader.csv(path), clean_names)
    groups = _by_header(spark, spark.read.text(path).inputFiles(), encoding)
    if len(groups) < 2 or infer_schema:
        parts = [_named(reader.csv(files), clean_names) for _, files in groups] or [_named(reader.csv(path), clean_names)]
    else:
        parts = [_named(_with_names(reader, names, files), clean_names)
                 for names, (_, files) in zip(_column_names(spark, [line for line, _ in groups], sep), groups)]
    for other in parts[1:]:
        odd = set(parts[0].columns) ^ set(other.columns)
        if odd:
            raise ValueError(f"files of {path} do not have the same columns: {sorted(odd)}")
    return reduce(DataFrame.unionByName, parts)


def _named(df: DataFrame, clean_names: bool) -> DataFrame:
    return clean_headers(df) if clean_names else df


def _with_names(reader, names: list[str | None], files: list[str]) -> DataFrame:
    """The files as text columns; a header with empty or equal names is left to the reader to name."""
    if None in names or len({n.lower() for n in names}) < len(names):
        return reader.csv(files)
    return reader.schema(StructType([StructField(n, StringType()) for n in names])).option("enforceSchema", "true").csv(files)


def _column_names(spark: SparkSession, lines: list[str], sep: str) -> list[list[str | None]]:
    """The fields of each header line, parsed by Spark's rules."""
    width = max(line.count(sep) for line in lines) + 1
    fields = ", ".join(f"f{i} STRING" for i in range(width))
    parsed = (spark.createDataFrame(list(enumerate(lines)), "i INT, line STRING")
              .select("i", "line", F.from_csv("line", fields, {"sep": sep}).alias("f")).collect())      # one row per distinct header
    found = []
    for row in sorted(parsed, key=lambda r: r["i"]):
        names = list(row["f"])
        least = 0 if '"' in row["line"] else row["line"].count(sep) + 1
        while len(names) > least and names[-1] is None:          # beyond the fields of this line
            names.pop()
        found.append(names)
    return found


def _first_line(spark: SparkSession, file: str, encoding: str) -> str | None:
    """A file's first line that isn't blank; only its first bytes are read, without a Spark job."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(hadoop).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop).getCodec(path)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
    try:
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        lines.close()


def _by_header(spark: SparkSession, files: list[str], encoding: str) -> list[tuple[str, list[str]]]:
    """The header lines, each with the files that have it; an empty file has no header and no rows."""
    files = [unquote(f) for f in files]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        heads = list(pool.map(lambda f: _first_line(spark, f, encoding), files))
    groups: dict[str, list[str]] = {}
    for file, head in zip(files, heads):
        if head is not None:
            groups.setdefault(head.removeprefix("\ufeff"), []).append(file)
    return list(groups.items())


def _encodable(df: DataFrame, encoding: str) -> DataFrame:
    """The same rows; running it fails on a text the encoding can't hold."""
    if encoding.upper() not in _NARROW:
        return df
    texts = set(string_columns(df))

    def checked(c: str) -> Column:
        col = F.col(f"`{c}`")
        kept = F.decode(F.encode(col, encoding), encoding) == col
        return F.when(col.isNull() | kept, col).otherwise(
            F.raise_error(F.concat(F.lit(f"{c}: not in {encoding}: "), col))).alias(c)

    return df.select(*[checked(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def write_report(df: DataFrame, path: str, *, sep: str = ",", header: bool = True,
                 encoding: str = "UTF-8", mode: str = "overwrite",
                 single_file: bool = False) -> str:
    """Write a report as delimited text; ``path`` becomes a folder of part files.

    ``single_file`` moves the finished rows to one task and is meant for bounded outputs
    only (top-n lists, per-group summaries); a full-size report keeps one file
    per partition so the write stays parallel.  Null is written as nothing and
    an empty text as ``""``; a character that ``encoding`` can't hold fails the write.
    """
    df = _encodable(df, encoding)
    # repartition, not coalesce: what computes the rows keeps its own parallelism
    out = df.repartition(1) if single_file else df
    (out.write.mode(mode).option("sep", sep).option("header", str(header).lower())
        .option("encoding", encoding).csv(path))
    return path


def read_report(spark: SparkSession, path: str, schema: StructType | str, *, sep: str = ",",
                header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """Read a report written by :func:`write_report` back with the writer's schema."""
    df = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
          .option("encoding", encoding).option("mode", "FAILFAST").option("emptyValue", _EMPTY_MARK).csv(path))
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[F.when(F.col(f"`{c}`") == _EMPTY_MARK, "").otherwise(F.col(f"`{c}`")).alias(c)
                       if c in texts else F.col(f"`{c}`") for c in df.columns])
