"""CSV folders read by column name, with bad rows kept apart.

Files of one folder may name their columns in any order, lack some and bring
new ones.  Spark binds a given schema to a CSV file by position and takes one
file's header for all, so files are grouped by their own header first: one
scan per distinct header, and the scans are united by name.  The number of
scans is the number of layouts a supplier has used, not of files.

Quotes inside quoted values are doubled (RFC 4180), and a quoted value may
hold line breaks.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How a quote inside a quoted value is written.
QUOTING = {"quote": '"', "escape": '"'}
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Columns that ``rows`` adds: where a row is from, its text if it is bad, and what is wrong with it.
FILE, RAW, REASONS = "_file", "_raw", "_reasons"
REASON_TYPE = "array<struct<column:string,reason:string>>"
FIELDS = "wrong number of fields"


@dataclass(frozen=True)
class Layout:
    """The files that share one header."""

    header: tuple[str, ...]
    files: tuple[str, ...]


def _options(multi_line: bool) -> dict[str, str]:
    # Without column pruning a row's fields are counted whatever columns a query reads.  A null value that no file
    # holds keeps an empty value in quotes apart from a missing one.
    return {**QUOTING, "header": "true", "multiLine": str(multi_line).lower(), "columnPruning": "false", "nullValue": "\0"}


def data_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Non-empty files at or under ``path``: a listing, no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return sorted(r[0] for r in found.where("length > 0").select("_metadata.file_path").toLocalIterator())


def layouts(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True, threads: int = 16) -> list[Layout]:
    """The distinct headers under ``path`` and their files; of each file only the first row is read.

    A header's names lose outer blanks and a byte-order mark.  A name that a
    header repeats, or leaves empty, gets the number that Spark's reader gives it.
    """
    files = data_files(spark, path)

    def header(file: str) -> tuple[str, ...]:
        names = spark.read.options(**_options(multi_line)).csv(file).columns
        return tuple(n.replace("﻿", "").strip() for n in names)

    with ThreadPoolExecutor(min(threads, max(1, len(files)))) as pool:
        headers = list(pool.map(header, files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, headers, strict=True):
        if names:
            groups.setdefault(names, []).append(file)
    return [Layout(h, tuple(fs)) for h, fs in sorted(groups.items())]


def _text(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _scan(spark: SparkSession, layout: Layout, contract: T.StructType, multi_line: bool) -> DataFrame:
    """Rows of one layout, typed by the contract, with ``FILE``, ``RAW`` and ``REASONS``.

    Values are read as text and cast as ``contracts.conform`` casts them, so
    what is wrong with a row does not hang on the columns that a query reads.
    """
    if len({n.lower() for n in layout.header}) < len(layout.header):
        raise ValueError(f"header names a column twice: {layout.header} in {layout.files[0]}")
    type_of = {f.name: f.dataType for f in contract.fields if not isinstance(f.dataType, T.StringType)}
    df = (spark.read.schema(_text([*layout.header, RAW]))
          .options(**_options(multi_line), mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
          .csv(list(layout.files)).withColumn(FILE, F.col("_metadata.file_path")))
    bad: list[Column] = [F.when(F.col(RAW).isNotNull(), _reason(None, FIELDS))]
    columns = []
    for name in layout.header:
        value = F.col(f"`{name}`")
        if name in type_of:  # blank text is no value of any other type
            text, kind = F.nullif(F.trim(value), F.lit("")), type_of[name]
            value = text.try_cast(kind)
            bad.append(F.when(F.col(RAW).isNull() & text.isNotNull() & value.isNull(), _reason(name, f"not {kind.simpleString()}")))
        columns.append(value.alias(name))
    reasons = F.filter(F.array(*bad), lambda r: r.isNotNull())
    record = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in layout.header]), QUOTING | KEEP_BLANKS)
    return df.withColumn(REASONS, F.when(F.size(reasons) > 0, reasons).cast(REASON_TYPE)).select(
        *columns, FILE, F.when(F.col(REASONS).isNotNull(), F.coalesce(F.col(RAW), record)).alias(RAW), REASONS)


def _reason(column: str | None, reason: str) -> Column:
    return F.struct(F.lit(column).cast("string").alias("column"), F.lit(reason).alias("reason"))


def rows(spark: SparkSession, path: str | Sequence[str], contract: T.StructType, *, extra: bool = True,
         multi_line: bool = True, found: Sequence[Layout] | None = None) -> DataFrame:
    """Every row under ``path``: the contract's columns by name, then new columns as text, then ``FILE``, ``RAW``, ``REASONS``.

    A column that a file lacks is null in its rows.  ``RAW`` and ``REASONS``
    are null for a good row.  ``multi_line=False`` lets Spark split a file
    among tasks, where no value holds a line break.  ``found`` are the
    layouts, where they are known already.
    """
    found = layouts(spark, path, multi_line) if found is None else found
    news: list[str] = []
    for layout in found:
        news += [n for n in layout.header if n not in contract.names and n not in news]
    news = sorted(news) if extra else []
    out = None
    for layout in found:
        df = _scan(spark, layout, contract, multi_line)
        have = set(layout.header)
        columns = [F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in contract.fields]
        columns += [F.col(f"`{n}`") if n in have else F.lit(None).cast("string").alias(n) for n in news]
        df = df.select(*columns, FILE, RAW, REASONS)
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], T.StructType([
            *contract.fields, *[T.StructField(n, T.StringType()) for n in (FILE, RAW)],
            T.StructField(REASONS, T.ArrayType(_text(["column", "reason"])))]))
    return out


def split(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``rows`` once, good and bad rows to folders of their own; return (good rows, rejects).

    Rejects are (file, raw, reasons): the row's text, as it stood where its
    fields do not match the header, else its values as CSV, fit to be mended
    and loaded again.  Their numbers add up to the rows read.
    """
    df.withColumn("accepted", F.col(REASONS).isNull()).write.partitionBy("accepted").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("accepted", T.BooleanType())])
    written = df.sparkSession.read.schema(schema).parquet(path)
    good = written.where("accepted").drop(FILE, RAW, REASONS, "accepted")
    return good, written.where("NOT accepted").select(F.col(FILE).alias("file"), F.col(RAW).alias("raw"), F.col(REASONS).alias("reasons"))


def drift(spark: SparkSession, found: Sequence[Layout], expected: Sequence[str], loaded: DataFrame | None = None) -> DataFrame:
    """Per file and column: ``ok``, ``missing`` or ``new``, the column's place in the file, and its values there.

    ``loaded`` (what ``rows`` gives, or a written copy) adds how many rows of
    the file carry a value: one aggregate of a pass over the data.
    """
    heads = []
    for i, layout in enumerate(found):
        for c in sorted({*layout.header, *expected}):
            place = layout.header.index(c) if c in layout.header else None
            heads.append((i, c, "missing" if place is None else "ok" if c in expected else "new", place))
    by_layout = spark.createDataFrame(heads, "layout int, column string, status string, place int")
    # Files are as many as a scan's own file listing holds.
    files = spark.createDataFrame([(i, f) for i, layout in enumerate(found) for f in layout.files], "layout int, file string")
    out = files.join(by_layout, "layout").drop("layout")
    if loaded is None:
        return out
    columns = [c for c in loaded.columns if c not in (FILE, RAW, REASONS)]
    counts = loaded.groupBy(F.col(FILE).alias("file")).agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns])
    long = counts.select("file", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("non_null")) for c in columns])).alias("x")).select("file", "x.*")
    present = F.when(F.col("status") != "missing", F.coalesce(F.col("non_null"), F.lit(0)))
    return out.join(long, ["file", "column"], "left").withColumn("non_null", present)


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in every file, quotes doubled: what ``rows`` reads back."""
    df.write.mode(mode).options(**QUOTING, **KEEP_BLANKS).option("header", True).csv(path)
