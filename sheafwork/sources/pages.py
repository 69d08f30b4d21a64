"""Collection pages: a paged stream source, checks of responses and cursors, the raw archive and its gates."""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

# Keys that no archived page may have, at any depth, and how identifiers look.
SENSITIVE = ("cookie", "cookies", "authorization", "sessionid", "sid_guard", "passport_auth", "passport_assist", "passport_csrf_token", "password", "secret_key", "access_token", "refresh_token")
IDENTIFIER = "^[A-Za-z0-9_-]+$"
PAGE = "request_cursor string, response_cursor string, has_more boolean, http_status int, fetch_error string, raw string, fetched_at string"


def cursor_of(value: Column) -> Column:
    """A cursor as decimal text: null is 0; null where it is no whole number."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("0")))
    return F.when(text.rlike("^[0-9]+$"), text)


def count_of(value: Column, default: int) -> Column:
    """A page's size; null where it isn't above 0."""
    n = F.coalesce(value, F.lit(default))
    return F.when(n > 0, n)


def sensitive_keys(payload: Column) -> Column:
    """Keys of a JSON text, at any depth, that tell credentials, in order. Texts in values don't count: their quotes are escaped."""
    return F.regexp_extract_all(payload, F.lit('(?i)(?<!\\\\)"(' + "|".join(SENSITIVE) + ')"\\s*:'), F.lit(1))


def valid_identifier(value: Column) -> Column:
    return F.coalesce(value.rlike(IDENTIFIER), F.lit(False))


def responses(pages: DataFrame) -> DataFrame:
    """Pages (http_status, fetch_error, raw) with the first fault, platform status, cursor, has_more and items (JSON texts).

    A list that is missing is accepted only on a last page.
    """
    parsed = F.try_parse_json("raw")
    get = lambda path: F.get_json_object("raw", path)
    status, more = get("$.status_code").try_cast("int"), F.coalesce(get("$.has_more").isin("true", "1"), F.lit(False))
    items = F.from_json(get("$.aweme_list"), "array<string>")
    is_list = F.coalesce(F.ltrim(get("$.aweme_list")).startswith("["), F.lit(False))
    fault = (
        F.when(F.col("fetch_error") == "TIMEOUT", "timeout")
        .when(F.coalesce("fetch_error", F.lit("")) != "", "transport")
        .when(F.col("http_status").isNull(), "no_http_status")
        .when(F.col("http_status") != 200, "http")
        .when(parsed.isNull() | ~F.ltrim("raw").startswith("{"), "json")
        .when(status.isNull(), "no_status")
        .when(status != 0, "platform")
        .when(get("$.aweme_list").isNull() & more, "no_list")
        .when(get("$.aweme_list").isNotNull() & ~is_list, "list_shape")
    )
    rows = pages.withColumn("fault", fault)
    sound = F.col("fault").isNull()
    return rows.withColumns({"platform_status": status, "has_more": F.when(sound, more), "response_cursor": F.when(sound, F.coalesce(get("$.cursor"), F.lit("0"))), "items": F.when(sound, F.coalesce(items, F.array().cast("array<string>")))})


def archive_verdicts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Whether pages (run_id, page_number, raw, sha256) may be archived: invalid_id, secret, replay, conflict or new.

    stored: run_id, page_number, sha256. A page that is there already with the same digest is a replay, with another a conflict.
    """
    known = stored.select("run_id", "page_number", F.col("sha256").alias("has"))
    verdict = F.when(~valid_identifier(F.col("run_id")), "invalid_id").when(F.size(sensitive_keys(F.col("raw"))) > 0, "secret").when(F.col("has").isNull(), "new").when(F.col("has") == F.col("sha256"), "replay").otherwise("conflict")
    return incoming.join(known, ["run_id", "page_number"], "left").withColumn("verdict", verdict).drop("has")


def discovered(spark: SparkSession, run_folder: str) -> DataFrame:
    """page_number, sha256, byte_size of a run's pages as they are: files named page_<number>.json."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "page_*.json").load(run_folder)
    number = F.regexp_extract("path", r"page_(\d+)\.json$", 1).try_cast("int")
    return read.select(number.alias("page_number"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size")).where("page_number is not null")


def archive_differs(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Pages of a manifest (page_number, sha256, byte_size) that are missing or not as it says: missing, size, digest."""
    has = files.select("page_number", F.col("sha256").alias("h_sha"), F.col("byte_size").alias("h_size"))
    fault = F.when(F.col("h_sha").isNull(), "missing").when(F.col("h_size") != F.col("byte_size"), "size").when(F.col("h_sha") != F.col("sha256"), "digest")
    return manifest.join(has, "page_number", "left").select("page_number", fault.alias("fault")).where("fault is not null")


def pages_of_run(manifest: DataFrame | None, files: DataFrame) -> DataFrame:
    """A run's pages by its manifest, or by its files where there is none."""
    return files if manifest is None else manifest.select("page_number", "sha256", "byte_size")


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        module, _, name = options["fetch"].partition(":")
        self.fetch, self.count = getattr(importlib.import_module(module), name), int(options.get("count", "10"))
        self.until, self.options = options.get("until"), options

    def initialOffset(self) -> dict:
        return {"cursor": str(self.options.get("cursor", "0")), "done": False}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """The page at a cursor; the stream is done at the last page, or where it meets the cursor ``until``."""
        if start["done"]:
            return iter(()), start
        page = self.fetch(start["cursor"], self.count, self.options)
        raw = page.get("raw_response") or {}
        after, more = str(raw.get("cursor", "0")), bool(raw.get("has_more"))
        reached = self.until is not None and (int(after) <= int(self.until) if after.isdigit() and self.until.isdigit() else after == self.until)
        row = (start["cursor"], after, more, page.get("http_status"), page.get("fetch_error"), json.dumps(raw, ensure_ascii=False, sort_keys=True, separators=(",", ":")), page.get("fetched_at"))
        return iter([row]), {"cursor": after, "done": not more or after in ("0", start["cursor"]) or reached}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The same page again, as after a failure."""
        return self.read(start)[0] if start != end else iter(())

    def commit(self, end: dict) -> None:
        pass


class CollectionPages(DataSource):
    """A source of pages by cursor: spark.readStream.format("collection_pages").option("fetch", "module:function").

    function(cursor, count, options) returns http_status, fetch_error, raw_response and fetched_at. Offsets are cursors, so a
    stream's checkpoint goes on where the last run ended, and a page is asked for again only after a failure.
    """

    @classmethod
    def name(cls) -> str:
        return "collection_pages"

    def schema(self) -> str:
        return PAGE

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Reader(self.options)
