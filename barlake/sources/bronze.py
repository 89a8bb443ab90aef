"""Bronze bar files -> typed bars, instruments and rejects.

Layout: ``<raw_root>/<market>/<asset folder>/[sub/]<symbol>.txt``, each a CSV
with a bracketed header such as ``<TICKER>,<PER>,<DATE>,<TIME>,<OPEN>,...``.

``parse_lines`` is the one parser, used by the batch scan and by the stream.
It takes raw lines with their place and gives one row for each data line,
typed or with the reason why it can't be used; no line is lost and none fails
the job.  Columns are matched **by header name**, per file, so reordered or
missing optional columns parse correctly; the first of two equal names counts.
Blank lines are not lines.  Metadata comes from the path below the root,
whatever store it is in:

* symbol: file name without ``.txt`` (any case), upper-cased;
* asset type: the folder right under the market directory, via a fixed map;
* sector: stocks whose symbol starts ``<digit><3 digits/letters>`` -> ``<digit>000``.

``reject="row"`` keeps the good rows of a file, ``reject="file"`` drops a whole
file when any row is bad (the reference's behaviour).  A file without the
required columns has no good row.
"""

from __future__ import annotations

import logging
import os
import re
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.instruments import instruments_from_bars
from barlake.session import materialize, path_exists, split_size

log = logging.getLogger(__name__)

# Fixed values that must equal the reference's: folder -> asset type, header -> column.
FOLDER_TO_ASSET_TYPE = {
    "tse stocks": "stock",
    "tse etfs": "etf",
    "tse indices": "index",
    "tse futures": "future",
    "tse options": "option",
    "tse corporate bonds": "bond",
    "tse treasury bonds": "bond",
}
NUMBERS = {"<OPEN>": "open", "<HIGH>": "high", "<LOW>": "low", "<CLOSE>": "close"}
COUNTS = {"<VOL>": "volume", "<OPENINT>": "open_interest"}
REQUIRED_HEADERS = ("<TICKER>", "<DATE>", *NUMBERS)

LINE_COLUMNS = ["file_path", "block", "line_id", "value"]
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


@dataclass
class Extract:
    bars: DataFrame        # symbol, market, asset_type, date, open..close, volume, open_interest, src_pos
    instruments: DataFrame  # symbol, market, asset_type, sector_code, listed_at
    rejects: DataFrame      # file_path, line, reason


def symbol_from_path(path: Column) -> Column:
    """``.../7203.jp.txt`` -> ``7203.JP``; ``^tpx.txt`` -> ``^TPX``."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.upper(F.regexp_replace(name, r"(?i)\.txt$", ""))


def relative_parts(path: Column, raw_root: str) -> Column:
    """Path components below ``raw_root`` (NULL when the file is outside it).

    Scheme and authority are left out on both sides: Spark may name a file
    ``file:/x`` or ``hdfs://host:port/x`` where the caller said ``/x``.
    """
    plain = re.sub(SCHEME, "", raw_root)
    root = (plain if plain != raw_root or raw_root.startswith("/") else os.path.abspath(raw_root)).rstrip("/") + "/"
    below = F.regexp_replace(path, SCHEME, "")
    return F.when(below.startswith(root), F.split(F.substring(below, len(root) + 1, 1 << 30), "/"))


def asset_type_from_path(path: Column, raw_root: str) -> Column:
    """Second component under ``raw_root`` (lower-cased) through the folder map; NULL if unknown."""
    parts = relative_parts(path, raw_root)
    folder = F.lower(F.when(F.size(parts) >= 2, F.element_at(parts, 2)))
    mapping = F.create_map(*[x for k, v in FOLDER_TO_ASSET_TYPE.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(mapping, folder)


def file_path_column() -> Column:
    """The file's path as written in the store (the metadata column is percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def parse_lines(lines: DataFrame, raw_root: str, market: str, asset_types: set[str] | None = None) -> DataFrame:
    """One row for each data line of (file_path, block, line_id, value): typed fields and ``reason`` (NULL: good).

    A file's first line, by (block, line_id), is its header; only lines of
    block 0 can be.  Files of unknown folders are left out.
    """
    lines = lines.where(F.trim(F.regexp_replace("value", r"\r$", "")) != "")
    split = lambda c: F.split(F.regexp_replace(c, r"\r$", ""), ",")
    both = {c: h for h, c in (NUMBERS | COUNTS).items()} | {"date": "<DATE>"}
    # what the path and the header tell is found once for each file: a header's place is NULL if it is not there
    place = lambda h: (F.nullif(F.array_position("names", h), F.lit(0)) - 1).cast("int")
    first = (lines.where("block = 0").groupBy("file_path").agg(F.min("line_id").alias("head_id"), F.min_by("value", "line_id").alias("head"))
             .select("file_path", "head_id", asset_type_from_path(F.col("file_path"), raw_root).alias("asset_type"),
                     symbol_from_path(F.col("file_path")).alias("symbol"), F.transform(split("head"), lambda x: F.trim(x)).alias("names"))
             .where("asset_type is not null"))
    if asset_types:
        first = first.where(F.col("asset_type").isin(sorted(asset_types)))
    first = first.select("file_path", "head_id", "asset_type", "symbol", F.size("names").alias("n_names"), *[place(h).alias(f"at_{c}") for c, h in both.items()],
                         (F.size(F.array_except(F.array(*[F.lit(h) for h in REQUIRED_HEADERS]), "names")) > 0).alias("lacks"))
    rows = lines.join(first, "file_path").where("block > 0 or line_id <> head_id").withColumn("cells", split("value"))
    # the cell under a header; NULL if the header or the cell is not there or empty
    raw = rows.select("file_path", "block", "line_id", "value", "asset_type", "symbol", "lacks", (F.size("cells") != F.col("n_names")).alias("ragged"),
                      *[F.trim(F.get("cells", F.col(f"at_{c}"))).alias(f"raw_{c}") for c in both])
    raw = raw.withColumns({f"raw_{c}": F.nullif(f"raw_{c}", F.lit("")) for c in both})
    typed = raw.withColumns({"date": F.try_to_date("raw_date", "yyyyMMdd"), **{c: F.col(f"raw_{c}").try_cast("double") for c in NUMBERS.values()},
                             **{c: F.col(f"raw_{c}").try_cast("double").try_cast("bigint") for c in COUNTS.values()}})
    bad = F.lit(False)
    for c in (*NUMBERS.values(), *COUNTS.values()):
        bad = bad | (F.col(f"raw_{c}").isNotNull() & F.col(c).isNull())
    reason = (F.when(F.col("lacks"), "missing required columns")
              .when(F.col("ragged"), "field count differs from header")
              .when(F.col("date").isNull(), "unparseable date")
              .when(bad, "unparseable number"))
    return typed.select(
        "file_path", "symbol", F.lit(market).alias("market"), "asset_type", "date", *NUMBERS.values(), *COUNTS.values(),
        F.struct("file_path", "block", "line_id").alias("src_pos"), F.col("value").alias("line"), reason.alias("reason"))


def good_rows(parsed: DataFrame, reject: str = "row") -> DataFrame:
    """Parsed rows that become bars."""
    if reject not in ("row", "file"):
        raise ValueError("reject must be 'row' or 'file'")
    good = parsed.where("reason is null")
    if reject == "file":
        good = good.join(parsed.where("reason is not null").select("file_path").distinct(), "file_path", "left_anti")
    return good.drop("line", "reason", "file_path")


def rejected_lines(parsed: DataFrame, reject: str = "row") -> DataFrame:
    """(file_path, line, reason) of the lines that don't become bars."""
    bad = parsed.where("reason is not null")
    if reject == "file":
        bad = parsed.join(bad.select("file_path").distinct(), "file_path", "left_semi")
    return bad.select("file_path", "line", F.coalesce("reason", F.lit("file rejected")).alias("reason"))


def scan_lines(spark: SparkSession, market_dir: str) -> DataFrame:
    """The lines of all ``*.txt`` files below a folder, with their place."""
    scan = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(market_dir)
    return scan.select(file_path_column().alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("line_id"), "value")


def extract_market(
    spark: SparkSession,
    raw_root: str,
    market: str,
    asset_types: set[str] | None = None,
    limit: int | None = None,
    reject: str = "row",
    split_bytes: int | None = None,
) -> Extract:
    """Scan ``<raw_root>/<market>`` for ``*.txt``, parse each line once and store the result.

    ``limit`` keeps the first symbols, by name, that have a good row; ``split_bytes`` is the size
    of the splits in which the raw files, and they alone, are read (Spark's own if not given).
    """
    market_dir = f"{raw_root.rstrip('/')}/{market}"
    if path_exists(spark, market_dir):
        lines = scan_lines(spark, market_dir)
    else:
        log.warning("Market directory not found: %s", market_dir)
        lines = spark.createDataFrame([], "file_path string, block bigint, line_id bigint, value string")
    with split_size(spark, split_bytes) if split_bytes else nullcontext():
        parsed = materialize(parse_lines(lines, raw_root, market, asset_types))
    bars = good_rows(parsed, reject)
    if limit is not None:
        bars = bars.join(bars.select("symbol").distinct().orderBy("symbol").limit(limit), "symbol", "left_semi")
    # listed_at: first raw bar date, before any validation (reference rule)
    return Extract(bars, instruments_from_bars(bars), rejected_lines(parsed, reject))
