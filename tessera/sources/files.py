"""Readers for the native text formats (ratings, item titles, people, orders,
weather, free text, adjacency lists, quoted name lists, label/feature CSV)
and the similarity sink.

Every schema is declared; nothing is inferred.  Fields are taken by
position from split lines, as the original parsers do (extra fields are
ignored, nothing is quoted).  ``mode='FAILFAST'`` (the default) raises on a
malformed number or a missing field as the original jobs do;
``mode='PERMISSIVE'`` turns such fields into nulls.  Any Hadoop URI works as a path
(local, HDFS, object stores), and a DataFrame with a string column ``value``
(one row per line) can stand in its place.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expressions import jvm_trim, trimmed_split

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"

_RATING_TYPES = {"int", "double", "float", "string"}


def _text(spark: SparkSession, path) -> DataFrame:
    """The lines of a path, or a DataFrame of lines as it is."""
    return path.select("value") if isinstance(path, DataFrame) else spark.read.text(path)


def _delimited(spark: SparkSession, path, sep: str, fields: list[tuple[str, str]],
               mode: str) -> DataFrame:
    """Lines split on ``sep`` with the fields taken by position, as the
    original parsers do: extra fields are ignored, there is no quoting.
    FAILFAST casts strictly (a bad number or a missing field fails the job);
    PERMISSIVE yields nulls instead.  Blank lines are skipped."""
    parts = F.split(F.col("value"), re.escape(sep))
    cols = []
    for idx, (name, dtype) in enumerate(fields):
        if mode == FAILFAST:
            c = F.element_at(parts, idx + 1)
            c = c if dtype == "string" else c.cast(dtype)
        else:
            c = F.try_element_at(parts, F.lit(idx + 1))
            c = c if dtype == "string" else c.try_cast(dtype)
        cols.append(c.alias(name))
    return (_text(spark, path)
            .where(F.length(F.col("value")) > 0)
            .select(*cols))


def _field_cast(fields, idx: int, dtype: str, mode: str):
    """Field ``idx`` (0-based) of a split line, cast strictly (FAILFAST) or
    to null when it does not parse (PERMISSIVE)."""
    if mode == FAILFAST:
        return F.element_at(fields, idx + 1).cast(dtype)
    return F.try_element_at(fields, F.lit(idx + 1)).try_cast(dtype)


# ---------------------------------------------------------------- ratings

def read_ratings_tsv(spark: SparkSession, path, rating_type: str = "int",
                     mode: str = FAILFAST) -> DataFrame:
    """A1: ``user<TAB>item<TAB>rating<TAB>ts``."""
    if rating_type not in _RATING_TYPES:
        raise ValueError(rating_type)
    return _delimited(spark, path, "\t", [("user_id", "int"), ("item_id", "int"),
                                          ("rating", rating_type), ("ts", "bigint")], mode)


def read_ratings_whitespace(spark: SparkSession, path, rating_type: str = "double",
                            mode: str = FAILFAST) -> DataFrame:
    """A2: the same file split on any run of whitespace."""
    f = trimmed_split(F.col("value"))
    df = _text(spark, path).where(F.col("value").rlike(r"\S"))
    return df.select(
        _field_cast(f, 0, "int", mode).alias("user_id"),
        _field_cast(f, 1, "int", mode).alias("item_id"),
        _field_cast(f, 2, rating_type, mode).alias("rating"),
    )


def read_ratings_dcolon(spark: SparkSession, path, mode: str = FAILFAST) -> DataFrame:
    """A3: ``user::item::rating::ts`` (multi-character separator)."""
    return _delimited(spark, path, "::", [("user_id", "int"), ("item_id", "int"),
                                          ("rating", "double"), ("ts", "bigint")], mode)


# ---------------------------------------------------------------- dimensions

def read_item_titles(spark: SparkSession, path, sep: str = "|",
                     encoding: str = "UTF-8") -> DataFrame:
    """``id<sep>title<sep>...`` item dimension.

    Lines are decoded with ``encoding`` (UTF-8 replaces undecodable bytes
    with U+FFFD, as the original loader does; ``ISO-8859-1`` keeps the true
    characters).  Blank lines are skipped, a line without a title field is
    dropped, and when an id repeats the line that comes last wins: in the file
    whose path sorts last, at the latest place in it.
    """
    at = F.monotonically_increasing_id().alias("at")
    if isinstance(path, DataFrame):
        raw = path.select(F.col("value").alias("line"), F.struct(at).alias("_pos")).where(F.length("line") > 0)
    else:
        raw = (spark.read
               .option("sep", "\u0001")      # never present: one column per line
               .option("quote", "")
               .option("header", "false")
               .option("encoding", encoding)
               .schema("line string")
               .csv(path)
               .select("line", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                        at).alias("_pos")))
    # the JVM split drops trailing empty fields: "3|" has one field, not two
    stripped = F.regexp_replace(F.col("line"), f"(?:{re.escape(sep)})+$", "")
    fields = F.split(stripped, re.escape(sep), 3)
    # only lines with a title field are parsed further (as in the original)
    parsed = (raw
              .select(fields.alias("_f"), "_pos")
              .where(F.size("_f") > 1)
              .select(F.element_at("_f", 1).cast("int").alias("item_id"),
                      F.element_at("_f", 2).alias("title"), "_pos"))
    return (parsed.groupBy("item_id")
            .agg(F.max_by("title", "_pos").alias("title")))


# ---------------------------------------------------------------- other CSVs

def read_people(spark: SparkSession, path, mode: str = FAILFAST) -> DataFrame:
    """``id,name,age,num_friends``."""
    return _delimited(spark, path, ",", [("id", "int"), ("name", "string"),
                                         ("age", "int"), ("num_friends", "int")], mode)


def read_customer_orders(spark: SparkSession, path, mode: str = FAILFAST) -> DataFrame:
    """``customer,item,amount``; the customer key stays a string."""
    return _delimited(spark, path, ",", [("customer_id", "string"), ("item_id", "string"),
                                         ("amount", "double")], mode)


def read_weather(spark: SparkSession, path, mode: str = FAILFAST) -> DataFrame:
    """``station,date,type,value,...`` (value in tenths of a degree C)."""
    return _delimited(spark, path, ",", [("station", "string"), ("date", "string"),
                                         ("entry_type", "string"), ("value", "float")], mode)


def read_label_features(spark: SparkSession, path, mode: str = FAILFAST) -> DataFrame:
    """``label,x``."""
    return _delimited(spark, path, ",", [("label", "double"), ("x", "double")], mode)


# ---------------------------------------------------------------- text

def read_lines(spark: SparkSession, path, repair_utf8: bool = False) -> DataFrame:
    """One row per line, column ``value``.

    The text source passes bytes through undecoded; ``repair_utf8`` replaces
    invalid UTF-8 sequences with U+FFFD (A6 for plain text files).
    """
    df = _text(spark, path)
    if repair_utf8:
        df = df.select(F.make_valid_utf8("value").alias("value"))
    return df


def read_byte_lines(spark: SparkSession, path) -> DataFrame:
    """Lines as they are in the file, column ``line`` (binary)."""
    return _text(spark, path).select(F.col("value").cast("binary").alias("line"))


def decode_lines(lines: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Lines of bytes as text, column ``value``.  UTF-8: every broken sequence becomes
    U+FFFD; other charsets are decoded as they are (``ISO-8859-1`` knows every byte)."""
    if encoding.upper() in ("UTF-8", "UTF8"):
        text = F.make_valid_utf8(F.col("line").cast("string"))
    else:
        text = F.decode("line", encoding)
    return lines.select(text.alias("value"))


# ---------------------------------------------------------------- graph

def read_adjacency(spark: SparkSession, path) -> DataFrame:
    """``id n1 n2 ...`` lines to directed edges ``(src, dst)``.

    A node may span several lines; every listed neighbour is one edge
    (multi-edges kept).  Trailing blanks do not create fields; blank lines
    are skipped.
    """
    f = trimmed_split(F.col("value"))
    lines = (_text(spark, path)
             .where(F.col("value").rlike(r"\S"))
             .select(f.alias("f")))
    return lines.select(
        F.element_at("f", 1).cast("bigint").alias("src"),
        F.explode(F.slice("f", 2, F.size("f") - 1).cast("array<bigint>")).alias("dst"),
    )


def read_adjacency_nodes(spark: SparkSession, path) -> DataFrame:
    """First field of every adjacency line with its neighbour count
    (``connections`` per line; zero for a line with only the node)."""
    f = trimmed_split(F.col("value"))
    return (_text(spark, path)
            .where(F.col("value").rlike(r"\S"))
            .select(F.element_at(f, 1).cast("bigint").alias("id"),
                    (F.size(f) - 1).alias("connections")))


def read_names(spark: SparkSession, path, cut_alias: bool = True,
               max_id: int | None = None) -> DataFrame:
    """``id "NAME/ALIAS"`` lines to ``(id, name)``.

    A line parses when something other than quote characters follows its
    first quote (the JVM split drops trailing empty fields); other lines
    are dropped.  ``cut_alias`` keeps the text before the first ``/``;
    ``max_id`` keeps only ids below it.
    """
    v = F.col("value")
    parts = F.split(v, '"')
    after_first = F.regexp_extract(v, '^[^"]*"(.*)$', 1)
    ok = F.instr(v, '"') > 0
    ok = ok & (F.length(F.regexp_replace(after_first, '"', "")) > 0)
    name = F.element_at(parts, 2)
    if cut_alias:
        name = F.substring_index(name, "/", 1)
    df = (_text(spark, path)
          .where(ok)
          .select(jvm_trim(F.element_at(parts, 1)).cast("bigint").alias("id"),
                  name.alias("name")))
    if max_id is not None:
        df = df.where(F.col("id") < F.lit(max_id))
    return df


# ---------------------------------------------------------------- literal tables

def id_table(spark: SparkSession, ids, name: str = "userId", dtype: str = "int") -> DataFrame:
    """A one-column table of caller-supplied ids (a query parameter)."""
    return spark.createDataFrame([(int(i),) for i in ids], f"{name} {dtype}")


# ---------------------------------------------------------------- sinks

def write_pairs(pairs: DataFrame, path: str, fmt: str = "parquet",
                mode: str = "overwrite", ranges: int | None = None) -> None:
    """All pair similarities, globally sorted by ``(i1, i2)``.

    Range-partitioned by both, so the files come out in key order
    without funnelling them through one task, however many pairs one item has.  Beside them, in
    ``<path>_zones``, stands a zone map: per file its first and last pair and its rows.
    """
    out = pairs.repartitionByRange(ranges, "i1", "i2") if ranges else pairs.repartitionByRange("i1", "i2")
    (out.sortWithinPartitions("i1", "i2")
     .write.mode(mode).format(fmt)
     .option("header", "true" if fmt == "csv" else "false")
     .save(path))
    spark = pairs.sparkSession
    written = spark.read.format(fmt).schema(pairs.schema).option("header", "true" if fmt == "csv" else "false").load(path)
    key = F.struct("i1", "i2")
    (written.groupBy(F.col("_metadata.file_name").alias("file"))
     .agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").parquet(path.rstrip("/") + "_zones"))


def pair_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone map of ``write_pairs``: ``(file, first, last, rows)``."""
    return spark.read.parquet(path.rstrip("/") + "_zones")


def read_pairs_of(spark: SparkSession, path: str, item, other=None) -> DataFrame:
    """The pairs whose first item is ``item`` (with ``other``: that one pair), from
    the files whose range holds them (Parquet): one file for a pair, usually one
    for an item, more for an item with many pairs."""
    t, first, last = F.lit(item), F.col("first.i1"), F.col("last.i1")
    holds, wanted = (first <= t) & (last >= t), F.col("i1") == t
    if other is not None:
        o = F.lit(other)
        holds = holds & ((first < t) | (F.col("first.i2") <= o)) & ((last > t) | (F.col("last.i2") >= o))
        wanted = wanted & (F.col("i2") == o)
    files = [r["file"] for r in pair_zones(spark, path).where(holds).select("file").collect()]
    if not files:
        return spark.read.parquet(path).where(F.lit(False))
    return spark.read.parquet(*[f"{path.rstrip('/')}/{f}" for f in files]).where(wanted)
