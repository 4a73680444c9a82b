"""Indicator payload and catalogue sources (landed JSON documents).

The source system answers ``GET /indicators/{id}`` with a JSON object whose
``indicator.values`` array holds the observations, and ``GET /indicators`` with
``{"indicators": [{"id", "name"}, ...]}``. Fetching is outside Spark; the
documents land as files (one directory per indicator, ``indicator_id=<id>``) and
are read here with an explicit schema — no inference, no driver loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.schemas import CATALOGUE, PAYLOAD, PAYLOAD_ITEM


CORRUPT = "_corrupt_record"
# Schema of a landed document as read
# (the indicator id, and the day of the fetch where it is part of the path, come from the directory).
LANDED = T.StructType(
    PAYLOAD.fields
    + [
        T.StructField(CORRUPT, T.StringType()),
        T.StructField("indicator_id", T.StringType()),
        T.StructField("fetch_date", T.StringType()),
    ]
)


def _answer_columns() -> list[Column]:
    """``fetched_at``: the fetch date of the folder, then the time of the file, as text that sorts by time; ``document``: the file."""
    at = F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fetched = F.concat_ws(" ", F.coalesce(F.col("fetch_date").cast("string"), F.lit("")), at)
    return [fetched.alias("fetched_at"), F.col("_metadata.file_path").alias("document")]


def landed_documents(df: DataFrame) -> DataFrame:
    """Raw read of landed documents -> (indicator_id, indicator, bad_doc, fetched_at, document); one answer per file."""
    return df.select(
        F.col("indicator_id").try_cast("int").alias("indicator_id"),
        "indicator",
        F.col(CORRUPT).isNotNull().alias("bad_doc"),
        *_answer_columns(),
    )


def read_payload_files(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    since: dt.date | None = None,
    below: int | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Landed payload files under ``path/indicator_id=<id>/[fetch_date=<day>/]``.

    The indicator id comes from partition discovery on the directory name. A
    document that does not parse is kept as a row with ``bad_doc`` set (its
    indicator must fail), not dropped. ``since`` prunes the directories of
    earlier fetches (an answer cannot hold what was published after its fetch);
    files that land without a fetch date are always read. ``below`` (bytes) and
    ``only`` (names) choose files as they are listed.
    """
    df = (
        spark.read.schema(LANDED)
        .option("multiLine", str(multiline).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    if since is not None:
        df = df.where(F.col("fetch_date").isNull() | (F.col("fetch_date") >= since.isoformat()))
    if below is not None:
        df = df.where(F.col("_metadata.file_size") < below)
    if only is not None:
        df = df.where(F.col("_metadata.file_path").isin(only))
    return landed_documents(df)


#: Answers of at least so many bytes are read in pieces, by many tasks.
SPLIT_BYTES = 64 * 1024 * 1024

#: Where the items begin, and the text of one item, from the brace that opens it.
_VALUES = r'(?s)^(.*"values"\s*:\s*\[).*$'
_ITEM = r'(?s)^(?:.*"values"\s*:\s*\[|\s*,)\s*(\{[^{}]*)$'


def _pieces(spark: SparkSession, path: str, since: dt.date | None, split_bytes: int) -> DataFrame:
    """The text of large answers, cut at every closing brace: piece, where it stands in its file, and its answer.

    Spark's text reader cuts a file at byte ranges and finds the separators itself, so one document is
    read by many tasks.
    """
    df = spark.read.option("lineSep", "}").text(path)
    day = F.col("fetch_date").cast("string") if "fetch_date" in df.columns else F.lit(None).cast("string")
    df = df.where(F.col("_metadata.file_size") >= split_bytes).withColumn("fetch_date", day)
    if since is not None:
        df = df.where(F.col("fetch_date").isNull() | (F.col("fetch_date") >= since.isoformat()))
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    return df.select(F.col("value").alias("piece"), at.alias("at"), F.col("indicator_id").cast("string").try_cast("int").alias("indicator_id"), *_answer_columns())


def _split_items(pieces: DataFrame) -> tuple[DataFrame, list[str]]:
    """(items of the answers that could be read in pieces, files that must be read whole).

    An answer is read in pieces if it has one array of values, which holds plain objects only, no brace
    stands inside a string, and what is left without the items is a valid document with that array in its
    place. Anything else, malformed documents included, is left to the reader of whole documents.
    """
    piece, at = F.col("piece"), F.col("at")
    starts, closes = piece.rlike(_VALUES), piece.rlike(r"^\s*\]")
    bare = F.regexp_replace(piece, r"(?s)\\.", "")
    odd = F.length(F.regexp_replace(bare, '[^"]', "")) % 2 == 1
    spans = pieces.groupBy("document").agg(
        F.min(F.when(starts, at)).alias("first"),
        F.collect_list(F.when(closes, at)).alias("closes"),  # one per array of objects
        ((F.count_if(starts) == 1) & ~F.bool_or(odd)).alias("plain"),
    )
    spans = spans.withColumn("end", F.array_min(F.filter("closes", lambda c: c > F.col("first")))).drop("closes")
    spans = spans.where(F.col("plain") & F.col("end").isNotNull()).withColumnRenamed("document", "_file")
    # One row a file of SPLIT_BYTES or more.
    placed = pieces.join(F.broadcast(spans), F.col("document") == F.col("_file"))
    inside = (at >= F.col("first")) & (at < F.col("end"))
    item = F.concat(F.regexp_extract(piece, _ITEM, 1), F.lit("}"))
    marked = F.when(at == F.col("first"), F.concat(F.regexp_extract(piece, _VALUES, 1), F.lit('{"_here":1'))).when(~inside, piece)
    frames = placed.groupBy("document").agg(
        F.count_if(inside & F.json_object_keys(item).isNull()).alias("odd_items"),
        F.sort_array(F.collect_list(F.when(marked.isNotNull(), F.struct("at", marked.alias("text"))))).alias("frame"),
    )
    text = F.array_join(F.col("frame.text"), "}")
    here = lambda t: F.coalesce((F.get_json_object(t, "$.indicator.values[0]._here") == "1") & F.json_object_keys(t).isNotNull(), F.lit(False))
    # A last piece ends with a brace or with the file.
    good = frames.where((F.col("odd_items") == 0) & (here(text) | here(F.concat(text, F.lit("}"))))).select("document")
    whole = pieces.select("document").distinct().join(good, "document", "left_anti")
    files = [r.document for r in whole.collect()]
    rows = placed.where(inside & ~F.col("document").isin(files)).select(
        "indicator_id", F.from_json(item, PAYLOAD_ITEM).alias("item"), "fetched_at", "document"
    )
    named = [F.col(f"item.{f.name}").alias(f.name) for f in PAYLOAD_ITEM.fields]
    return rows.select("indicator_id", *named, F.lit(False).alias("bad_doc"), "fetched_at", "document"), files


def read_items(
    spark: SparkSession, path: str, multiline: bool = True, since: dt.date | None = None, work: str | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The items of landed answers, ``explode_payload(read_payload_files(...))``, with large answers read by many tasks.

    A document that Spark's JSON reader takes as a whole is read by one task. With a ``work`` folder,
    documents of ``split_bytes`` or more are cut into pieces there, each piece an item (``_split_items``).
    Small files and large ones are told apart when the files are listed.
    """
    documents = read_payload_files(spark, path, multiline, since, below=split_bytes if multiline and work else None)
    items = explode_payload(documents)
    if not (multiline and work):
        return items
    _pieces(spark, path, since, split_bytes).write.mode("overwrite").parquet(f"{work}/pieces")
    pieces = spark.read.parquet(f"{work}/pieces")
    if pieces.isEmpty():
        return items
    split, files = _split_items(pieces)
    items = items.unionByName(split)
    if files:
        items = items.unionByName(explode_payload(read_payload_files(spark, path, multiline, since, only=files)))
    return items


def parse_payload(df: DataFrame, json_col: str = "payload") -> DataFrame:
    """A string column holding payload JSON -> ``indicator`` struct + ``bad_doc``.

    ``bad_doc``: the text is not a JSON object (malformed, or another JSON
    value); a valid object without ``indicator`` / ``values`` is simply empty.
    """
    parsed = F.from_json(F.col(json_col), PAYLOAD)
    bad = F.col(json_col).isNotNull() & F.json_object_keys(F.col(json_col)).isNull()
    return df.withColumn("indicator", parsed.getField("indicator")).withColumn("bad_doc", bad).drop(json_col)


def explode_payload(df: DataFrame) -> DataFrame:
    """One row per payload item: indicator_id, value, datetime, datetime_utc, geo_id, bad_doc.

    ``explode`` (not ``explode_outer``) drops documents whose ``indicator`` or
    ``values`` is missing, NULL or empty — those yield no rows. A document that
    did not parse (``bad_doc``) yields one empty item carrying the flag.
    """
    values = F.col("indicator").getField("values")
    bad = F.coalesce(F.col("bad_doc"), F.lit(False)) if "bad_doc" in df.columns else F.lit(False)
    one_empty = F.array(F.lit(None).cast(PAYLOAD_ITEM))
    item = F.explode(F.when(bad, one_empty).otherwise(values)).alias("item")
    named = [c for c in ("fetched_at", "document") if c in df.columns]
    return df.select("indicator_id", item, bad.alias("bad_doc"), *named).select(
        "indicator_id",
        F.col("item.value").alias("value"),
        F.col("item.datetime").alias("datetime"),
        F.col("item.datetime_utc").alias("datetime_utc"),
        F.col("item.geo_id").alias("geo_id"),
        "bad_doc",
        *named,
    )


def read_catalogue_files(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Landed catalogue documents -> (indicators array)."""
    return spark.read.schema(CATALOGUE).option("multiLine", str(multiline).lower()).json(path)


def parse_catalogue(df: DataFrame, json_col: str = "payload") -> DataFrame:
    return df.select(F.from_json(F.col(json_col), CATALOGUE).getField("indicators").alias("indicators"))


def explode_catalogue(df: DataFrame) -> DataFrame:
    """One row per catalogue entry (id, name)."""
    return df.select(F.explode("indicators").alias("i")).select(
        F.col("i.id").alias("id"), F.col("i.name").alias("name")
    )


def search_catalogue(entries: DataFrame, text_filter: str | None = None) -> DataFrame:
    """Case-insensitive substring filter on the name, sorted by id.

    An empty or missing filter returns the whole catalogue; an entry without a
    name never matches a non-empty filter.
    """
    out = entries
    if text_filter:
        needle: Column = F.lit(text_filter.lower())
        out = out.where(F.contains(F.lower(F.coalesce(F.col("name"), F.lit(""))), needle))
    return out.orderBy("id")
