"""Exported files and tables as DataFrames with the layouts of ``schemas``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import numeric as num, text, time as tm
from ..operators.attribution import brand_mapping
from ..operators.common import salted_join
from ..session import scratch_path

# Export header -> column.
EVENT_COLUMNS = {
    "ID": "event_id", "EXTERNAL_USER_ID": "external_user_id", "NETWORK_USER_ID": "network_user_id",
    "TYPE": "event_type", "PIXEL_TS": "event_date", "PUBLISHER_ID": "publisher_id",
    "CAMPAIGN_ID": "campaign_id", "SUB_ID": "sub_id", "AFFILIATE_ID": "affiliate_id",
    "DEPOSIT_AMOUNT": "deposit_amount", "CURRENCY": "currency", "CONVERTED_AMOUNT": "converted_amount",
    "CONVERTED_CURRENCY": "converted_currency", "WEBSITE": "website", "COUNTRY": "country",
    "TRANSACTION_ID": "transaction_id",
}
PIXEL_COLUMNS = {**{("EVENT_ID" if k == "ID" else k): v for k, v in EVENT_COLUMNS.items()},
                 "ADVERTISER_ID": "advertiser_id"}
LATE_TIME = "EVENT_TS"


def parse_instant(text_column: Column) -> Column:
    """A timestamp written with or without a ``UTC`` suffix; unreadable text gives NULL."""
    return F.regexp_replace(text_column, " UTC$", "").try_cast("timestamp")


def _decoded(cell: Column) -> Column:
    """A cell read byte by byte, as the UTF-8 it holds or, where it is none, as Latin-1; trimmed, with plain line feeds.

    Behind a byte order mark the parser reads UTF-8 by itself; such cells show characters that bytes are not.
    Plain cells, of one line of ASCII without blanks around, are what most are and stay as they are.
    """
    read = F.encode(cell, "ISO-8859-1").cast("string")
    bytes_ = cell.rlike(r"[\x{80}-\x{FF}]") & ~cell.rlike(r"[^\x{00}-\x{FF}]")
    text_ = F.when(bytes_, F.when(F.is_valid_utf8(read), read).otherwise(cell)).otherwise(cell)
    told = F.replace(F.regexp_replace(text_, r"^ +|[ \r]+$", ""), F.lit("\r\n"), F.lit("\n"))
    return F.when(cell.rlike(r"[^\x20-\x7E]|^ | $"), told).otherwise(cell)


def _unmarked(cell: Column) -> Column:
    """The first cell of a record without a byte order mark, which hides the quote behind it."""
    return F.regexp_replace(cell, '(?s)^\ufeff"?(.*?)"?(\n?)$', "$1$2")


def _cells(raw: Column) -> Column:
    """The cells of a record decoded, never NULL."""
    return F.transform(F.transform(raw, lambda c: F.coalesce(_decoded(c), F.lit(""))), lambda c, i: F.when(i == 0, _unmarked(c)).otherwise(c))


def _path(at: Column) -> Column:
    """The decoded name of a file; a plus sign stands for itself in a path, not for a space."""
    return F.url_decode(F.replace(at, F.lit("+"), F.lit("%2B")))


def _occurrences(character: str) -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit(character), F.lit("")))


def _export_records(spark: SparkSession, path: str | Sequence[str], glob: str | None, files: Sequence[str] | None = None) -> DataFrame:
    """The records of CSV files as (place, raw, at), empty ones left out.

    One look over the lines finds the files in which a quoted cell holds line feeds.
    These are read record by record, each file by one task; all others are cut into lines
    and may be dealt to many tasks.  A file of the first kind whose quotes do not pair up
    fails by name, as its records cannot be told apart.

    ``raw`` holds the cells byte by byte, to be decoded by :func:`_cells` where they are needed;
    ``at`` is the file as Spark names it.  ``place`` ascends within a file and is negative for
    all but its first part.  ``files`` names those to read, as Spark does.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    chosen = F.lit(True) if files is None else F.col("_metadata.file_path").isin(list(files))
    lines = reader.text(path).filter(chosen).select(
        F.col("_metadata.file_path").alias("at"), _occurrences(",").alias("commas"), _occurrences('"').alias("quotes"))
    by_file = lines.groupBy("at").agg(F.max("commas").alias("commas"), F.sum("quotes").alias("quotes"), F.max(F.col("quotes") % 2).alias("odd"))
    # Few, and only their names.
    look = by_file.agg(F.max("commas").alias("widest"), F.collect_list(F.when(F.col("odd") == 1, F.struct("at", "quotes"))).alias("broken")).first()
    widest, broken = look["widest"] or 0, {r["at"]: r["quotes"] for r in look["broken"]}
    # The columns of a line; a header record may itself go over some lines.
    names = [f"c{i}" for i in range(4 * widest + 17 if broken else widest + 1)]
    # A record of fewer cells than columns costs the parser an exception, unless it looks for some columns only: all but one that is never there.
    rows = (reader.schema(", ".join(f"{n} string" for n in [*names, "beyond"])).option("escape", '"').option("encoding", "ISO-8859-1")
            .option("columnPruning", True).option("maxCharsPerColumn", -1).option("maxColumns", len(names) + 2))

    def read(multi_line: bool) -> DataFrame:
        own = F.col("_metadata.file_path").isin(list(broken))
        some = rows.option("multiLine", multi_line).csv(path).filter(chosen & (own if multi_line else ~own))
        place = F.monotonically_increasing_id()
        if not multi_line:
            place = F.when(F.col("_metadata.file_block_start") == 0, place).otherwise(-1)
        return some.select(place.alias("place"), F.array(*names).alias("raw"), F.col("_metadata.file_path").alias("at"))

    records = read(False)
    if broken:
        whole, unpaired = read(True), [at for at, quotes in broken.items() if quotes % 2]
        if unpaired:
            torn = F.raise_error(F.concat(F.lit("quotes do not pair up in "), F.url_decode("at"))).cast("string")
            over_lines = F.exists("raw", lambda c: F.coalesce(c.contains("\n"), F.lit(False)))
            whole = whole.withColumn("_told", F.when(F.col("at").isin(unpaired) & over_lines, torn)).filter(F.col("_told").isNull()).drop("_told")
        records = records.unionAll(whole)
    # More than blanks, or a byte order mark and the quotes behind it.
    return records.filter(F.exists("raw", lambda c: c.rlike(r'^(?! *(?:(?:\x{FEFF}|\x{EF}\x{BB}\x{BF})"{0,2})?[ \r]*\z)')))


def _first_records(records: DataFrame) -> DataFrame:
    """(at, _header) with the first record of every file."""
    first = records.filter("place >= 0").groupBy("at").agg(F.min(F.struct("place", "raw"))["raw"].alias("_raw"))
    return first.select("at", _cells(F.col("_raw")).alias("_header"))


def _kept(spark: SparkSession, headers: DataFrame) -> DataFrame:
    """Headers written to the shared folder, so that files are searched for them once, and Spark knows if they are few enough to be broadcast."""
    path = scratch_path(spark, "headers")
    headers.write.parquet(path)
    return spark.read.schema(headers.schema).parquet(path)


def _holds(*texts: str) -> Callable[[Column], Column]:
    """A first test of a record's text for the ASCII names among ``texts``, which decoding does not change."""
    plain = [t for t in texts if t.isascii() and t.isprintable() and t == t.strip()]

    def test(record: Column) -> Column:
        found = F.lit(True)
        for t in plain:
            found = found & record.contains(t)
        return found

    return test


def _by_own_header(records: DataFrame, is_header: Callable[[Column], Column] | None, wanted: Mapping[str, str], required: Sequence[str] = (),
                   spelled: Callable[[Column], Column] = lambda name: name, may_be: Callable[[Column], Column] | None = None,
                   first: DataFrame | None = None) -> DataFrame:
    """Columns ``wanted`` (header -> name) as text, found by name in each file's own header record.

    ``is_header`` tests a record's cells, where ``may_be``, a cheaper test of its undecoded text,
    does not rule it out.  Without ``is_header`` a file's first record (``first``) is its header.
    ``spelled`` normalises the header names.  A header that a file lacks gives NULL, one that is
    ``required`` fails, and so does a file without any header record; the message names the
    file.  Files of any number of layouts are read in one plan; a file's records are dealt
    to several tasks, and of each only the cells wanted are decoded.
    """
    spark, raw = records.sparkSession, F.col("raw")
    if is_header is None:
        headers, rest = _first_records(records) if first is None else first, records
    else:
        test = F.coalesce(is_header(_cells(raw)), F.lit(False))
        test = test if may_be is None else F.when(may_be(F.concat_ws("\n", raw)), test).otherwise(False)
        headers = records.filter(test).select("at", _cells(raw).alias("cells")).groupBy("at").agg(F.min("cells").alias("_header"))
        rest = records.filter(~test)
    path_, names = _path(F.col("at")), F.transform("_header", spelled)
    name = F.regexp_extract(F.regexp_replace(path_, r"/part-[^/]*$", ""), r"([^/]+)$", 1)
    lacks = F.lit(None).cast("string")
    for column in reversed(required):
        lacks = F.when(~F.array_contains("_names", column), F.lit(column)).otherwise(lacks)
    places = F.array(*[(F.nullif(F.array_position("_names", header), F.lit(0)) - 1).cast("int") for header in wanted]) if wanted else F.array().cast("array<int>")
    headers = headers.select("at", "_header", names.alias("_names"), path_.alias("file_path"), name.alias("file_name"))
    headers = _kept(spark, headers.select("at", "_header", "file_path", "file_name", lacks.alias("_lacks"), places.alias("_places")))
    rows = salted_join(rest.drop("place"), headers, ["at"])
    if is_header is None:
        rows = rows.filter(F.coalesce(_cells(raw) != F.col("_header"), F.lit(True)))
    told = (F.when(F.col("_places").isNull(), F.raise_error(F.concat(F.lit("no header line in "), path_)))
            .when(F.col("_lacks").isNotNull(), F.raise_error(F.concat(F.lit("no column "), F.col("_lacks"), F.lit(" in "), F.col("file_path")))))
    rows = rows.withColumn("_told", told.cast("string")).filter(F.col("_told").isNull())
    cells = F.transform("_places", lambda p: _decoded(F.get(raw, p)))
    cells = F.zip_with("_places", cells, lambda p, c: F.nullif(F.when(p == 0, _unmarked(c)).otherwise(c), F.lit("")))
    rows = rows.select(cells.alias("_cells"), "file_path", "file_name")
    return rows.select(*[F.get("_cells", F.lit(i)).alias(name) for i, name in enumerate(wanted.values())], "file_path", "file_name")


def _is_event_header(cells: Column, columns: Mapping[str, str]) -> Column:
    """A header record names the time and the type as cells; one of values does not."""
    test = F.lit(True)
    for header, name in columns.items():
        if name in ("event_date", "event_type"):
            test = test & F.array_contains(cells, header)
    return test


def _event_marks(columns: Mapping[str, str]) -> Callable[[Column], Column]:
    return _holds(*[header for header, name in columns.items() if name in ("event_date", "event_type")])


def unreadable_event_files(spark: SparkSession, path: str | Sequence[str], files: Sequence[str],
                           columns: Mapping[str, str] = PIXEL_COLUMNS) -> dict[str, str]:
    """Of some files of event exports, by the names Spark gives them, those that cannot be read, and why.

    They have no line that names the columns, or quotes that do not pair up, alone or over lines.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).filter(F.col("_metadata.file_path").isin(list(files)))
    bare = F.col("value")
    for mark in ('"', "\ufeff", "\r"):
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    # Few lines name the columns; only those are split.
    header = F.when(_event_marks(columns)(bare), _is_event_header(F.transform(F.split(bare, ","), F.trim), columns)).otherwise(False)
    quotes = _occurrences('"')
    found = {r["at"]: r for r in lines.groupBy(F.col("_metadata.file_path").alias("at")).agg(
        F.max(header).alias("header"), F.max(quotes % 2).alias("odd"), (F.sum(quotes) % 2).alias("torn")).collect()}
    bad = {}
    for name in files:
        if name not in found or not found[name]["header"]:
            bad[name] = "no header line"
        elif found[name]["odd"] and found[name]["torn"]:
            bad[name] = "quotes do not pair up"
    return bad


def _event_records(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str], glob: str | None,
                   files: Sequence[str] | None = None) -> DataFrame:
    """Event exports as text, under their header names."""
    records = _export_records(spark, path, glob, files)
    headers = [*columns, LATE_TIME]
    time = next(h for h, name in columns.items() if name == "event_date")
    return _by_own_header(records, lambda cells: _is_event_header(cells, columns), {h: h for h in headers}, [time], may_be=_event_marks(columns))


def _typed_events(raw: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename, add missing columns as NULL, and parse; bad numbers become NULL."""
    have = set(raw.columns)
    named = raw.select([
        (F.col(f"`{header}`") if header in have else F.lit(None)).cast("string").alias(name)
        for header, name in columns.items()
    ] + [(F.col(LATE_TIME) if LATE_TIME in have else F.lit(None)).cast("string").alias("_late")])
    integer = lambda c: F.coalesce(F.col(c).try_cast("bigint"), F.col(c).try_cast("double").try_cast("bigint"))
    return named.withColumns({
        "event_date": F.coalesce(parse_instant(F.col("event_date")), parse_instant(F.col("_late"))),
        "publisher_id": integer("publisher_id"), "campaign_id": integer("campaign_id"),
        "deposit_amount": F.col("deposit_amount").try_cast(schemas.MONEY),
        "converted_amount": F.col("converted_amount").try_cast(schemas.MONEY),
    }).filter(F.col("event_date").isNotNull())


def event_csv(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str] = EVENT_COLUMNS,
              glob: str | None = None) -> DataFrame:
    """Event exports, columns by each file's own header; rows without a readable time are dropped."""
    return schemas.conform(_typed_events(_event_records(spark, path, columns, glob), columns), schemas.USER_EVENTS)


def pixel_events(raw: DataFrame, brands: Mapping[int, str], until: tm.Day | None = None,
                 columns: Mapping[str, str] = PIXEL_COLUMNS) -> DataFrame:
    """Pixel rows with the brand from its id, up to the end of a day, with an event id.

    The columns of an export may vary.  Where the pixel time is missing the event's
    own time is used.
    """
    rows = _typed_events(raw, columns).withColumn(
        "advertiser", text.brand_from_id(F.col("advertiser_id"), brands))
    rows = rows.filter(F.col("event_id").isNotNull() & tm.within(F.col("event_date"), None, until))
    return schemas.conform(rows, schemas.USER_EVENTS)


def pixel_csv(spark: SparkSession, path: str | Sequence[str], brands: Mapping[int, str],
              until: tm.Day | None = None, glob: str | None = None, columns: Mapping[str, str] = PIXEL_COLUMNS,
              files: Sequence[str] | None = None) -> DataFrame:
    """Pixel exports, columns by each file's own header; ``columns`` names other headers, ``files`` the files to read."""
    return pixel_events(_event_records(spark, path, columns, glob, files), brands, until, columns)


# --- spend ------------------------------------------------------------------


def _spend_rows(spark: SparkSession, path, glob: str) -> DataFrame:
    """(publisher, deposits, spend, file_name) from exports with a preamble and a header line.

    Preamble lines carry no publisher id, so they drop out with the other rows that lack one.
    """
    records = _export_records(spark, path, glob)

    def is_header(cells: Column) -> Column:
        line = F.array_join(cells, ",")
        return line.contains("Publisher") & line.contains("Deposit") & line.contains("Spend") & text.publisher_id(line).isNull()

    wanted = {"Publisher": "publisher_name", "Deposit": "_deposit", "Spend": "_spend"}
    return _by_own_header(records, is_header, wanted, list(wanted), may_be=_holds("Publisher", "Deposit", "Spend"))


def _priced(rows: DataFrame) -> DataFrame:
    """Ids, formats and cost; unreadable numbers count as 0, zero deposits as 1."""
    deposits = num.number_or_zero(F.col("_deposit"), "double").cast("bigint")
    spend = num.number_or_zero(F.col("_spend"), "decimal(15,2)")
    rows = rows.withColumns({
        "publisher_id": text.publisher_id(F.col("publisher_name")),
        "format": text.ad_format(F.col("publisher_name")),
        "deposits_reported": deposits, "spend": spend,
    }).filter(F.col("publisher_id").isNotNull())
    cost = num.half_even(num.ratio_floor_one(F.col("spend"), F.col("deposits_reported")), 3)
    return rows.withColumn("current_cpa", cost.cast("decimal(10,3)"))


# Month names as they occur in file names.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]


def month_from_file_name(name: Column, year: int, default: str | None = None) -> Column:
    """``yyyy-MM`` from an English month name or its first three letters in a file name."""
    result = F.lit(default).cast("string")
    for number, month in reversed(list(enumerate(MONTHS, 1))):
        result = F.when(F.lower(name).contains(month[:3]), f"{year}-{number:02d}").otherwise(result)
    return result


def date_from_file_name(name: Column) -> Column:
    """The first valid date written 2025-11-01, 20251101 or 01-11-2025 in a file name."""
    # Pattern and the positions of year, month and day in it.
    forms = [(r"(\d{4})-(\d{2})-(\d{2})", (1, 2, 3)), (r"(\d{4})(\d{2})(\d{2})", (1, 2, 3)),
             (r"(\d{2})-(\d{2})-(\d{4})", (3, 2, 1))]
    found = [F.concat_ws("-", *[F.regexp_extract(name, pattern, i) for i in order]).try_cast("date")
             for pattern, order in forms]
    return F.coalesce(*found)


def monthly_spend_csv(spark: SparkSession, path: str | Sequence[str], month: str | None = None,
                      year: int | None = None, glob: str = "*.csv") -> DataFrame:
    """Monthly spend exports; the month is given, or read from the file name and ``year``."""
    if month is None and year is None:
        raise ValueError("give month, or year to read the month from the file name")
    rows = _priced(_spend_rows(spark, path, glob))
    value = F.lit(month) if month else month_from_file_name(F.col("file_name"), year)
    return schemas.conform(rows.withColumn("month", value), schemas.PUBLISHER_SPEND)


def daily_spend_csv(spark: SparkSession, path: str | Sequence[str], date: tm.Day | None = None,
                    glob: str = "*.csv") -> DataFrame:
    """Daily spend exports; the date is given or read from each file name.  A file without one fails by name."""
    rows = _priced(_spend_rows(spark, path, glob))
    undated = F.raise_error(F.concat(F.lit("no date in the name of "), "file_path")).cast("date")
    value = F.lit(tm._as_date(date)) if date else F.coalesce(date_from_file_name(F.col("file_name")), undated)
    rows = rows.withColumn("date", value).filter(F.col("date").isNotNull())
    return schemas.conform(rows, schemas.PUBLISHER_SPEND_DAILY)


# --- sheets -----------------------------------------------------------------


def _spelled(name: Column) -> Column:
    """A sheet's header as a column name, like ``functions.text.column_name``."""
    return F.regexp_replace(F.translate(F.lower(name), " -", "__"), "[^a-z0-9_]", "")


def campaign_sheet(spark: SparkSession, path: str | Sequence[str], sheet_id: str, attribution: str,
                   loaded_at: str | None = None, sheet_name: str | None = None) -> DataFrame:
    """One exported sheet, all text, with normalised column names and its origin.

    Of several files, each has its own header in its first record, and the sheet all their columns.
    """
    records = _export_records(spark, path, None)
    first = _kept(spark, _first_records(records))
    headers = [r["_header"] for r in first.groupBy("_header").agg(F.min(_path(F.col("at"))).alias("at")).orderBy("at").collect()]
    names = [n for n in dict.fromkeys(text.column_name(c) for header in headers for c in header) if n]
    rows = _by_own_header(records, None, {n: n for n in names}, spelled=_spelled, first=first).select(names)
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    origin = {"source_sheet_id": F.lit(sheet_id), "attribution_type": F.lit(attribution), "loaded_at": stamp}
    if sheet_name:
        origin["sheet_name"] = F.lit(sheet_name)
    return rows.withColumns(origin)


def campaign_sheets(spark: SparkSession, path: str | Sequence[str], sheets: DataFrame, loaded_at: str | None = None,
                    glob: str = "*.csv") -> DataFrame:
    """All exported sheets below a path in one scan, in the campaign layout; money stays text.

    ``sheets`` has one row per file: file_name, source_sheet_id, attribution_type and, if it
    likes, sheet_name.  Columns are found by each file's own header, in whatever spelling; a
    file without one, or that is not listed, fails by name.
    """
    origin = [c for c in ("source_sheet_id", "attribution_type", "sheet_name") if c in sheets.columns]
    texts = [f.name for f in schemas.CAMPAIGNS.fields if f.name not in (*origin, "loaded_at")]

    def is_header(cells: Column) -> Column:
        names = F.transform(cells, _spelled)
        return F.array_contains(names, "event_date") & F.array_contains(names, "campaignid")

    def may_be(record: Column) -> Column:
        # Letters of the two names; others than ASCII may become such in lower case.
        return (record.rlike("[vV]") & record.rlike("[pP]") & record.rlike("[gG]")) | record.rlike(r"[^\x00-\x7F]")

    rows = _by_own_header(_export_records(spark, path, glob), is_header, {c: c for c in texts}, ["event_date"], _spelled, may_be)
    listed = sheets.select("file_name", *origin, F.lit(True).alias("_listed"))
    rows = rows.join(listed, "file_name", "left")
    told = F.when(F.col("_listed").isNull(), F.raise_error(F.concat(F.lit("no sheet is listed for "), "file_path"))).cast("string")
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    return campaigns_from_sheets(rows.withColumn("_told", told).filter(F.col("_told").isNull()).withColumn("loaded_at", stamp))


def combine_sheets(sheets: Sequence[DataFrame]) -> DataFrame:
    """All sheets as one frame; a column some of them lack is NULL there."""
    result = sheets[0]
    for sheet in sheets[1:]:
        result = result.unionByName(sheet, allowMissingColumns=True)
    return result


def observed_types(df: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, decimal, boolean and timestamp that fits all text of each column.

    One aggregation over the data; whole numbers with gaps become decimal, and a date
    or time in the name makes a timestamp.
    """
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    # A cast that fails costs an exception a cell, so text that shows at once that it is no such value is not cast.
    possible = {"bigint": r"^[^\x21-\x7E]*[+-]?[^\x21-\x2F\x3A-\x7E]+$", "decimal(38,10)": r"^(?:[^\x21-\x7E]|[0-9eE+.-])+$",
                "boolean": r"(?i)^[^\x21-\x7E]*(t|true|y|yes|1|f|false|n|no|0)[^\x21-\x7E]*$"}
    fits = lambda c, t: F.min(F.when(F.col(c).isNull(), True).when(~F.col(c).rlike(f"(?s){possible[t]}"), False).otherwise(F.col(c).try_cast(t).isNotNull()))
    checks = []
    for c in names:
        checks += [fits(c, "bigint").alias(f"{c}#int"), fits(c, "decimal(38,10)").alias(f"{c}#dec"),
                   fits(c, "boolean").alias(f"{c}#bool"), F.count(c).alias(f"{c}#n")]
    seen = df.agg(F.count(F.lit(1)).alias("#rows"), *checks).first().asDict()
    types = {}
    for c in names:
        filled = seen[f"{c}#n"]
        if filled and seen[f"{c}#int"]:
            types[c] = "bigint" if filled == seen["#rows"] else "decimal(38,10)"
        elif filled and seen[f"{c}#dec"]:
            types[c] = "decimal(38,10)"
        elif filled == seen["#rows"] and filled and seen[f"{c}#bool"]:
            types[c] = "boolean"
        elif "date" in c.lower() or "time" in c.lower():
            types[c] = "timestamp"
        else:
            types[c] = "string"
    return types


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.select([F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def campaigns_from_sheets(sheets: DataFrame) -> DataFrame:
    """Combined sheets in the fixed campaign layout; money stays text."""
    have = set(sheets.columns)
    return sheets.select([
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schemas.CAMPAIGNS.fields])


# --- mappings, lists, databases ---------------------------------------------


def brand_csv(spark: SparkSession, path: str | Sequence[str], link: str = "event_id", brand: str = "Advertiser",
              date: str | None = None, spellings: Sequence[str] = ()) -> DataFrame:
    """Brand mapping exports, columns by each file's own header, one row per link."""
    wanted = [link, brand, *([] if date is None else [date])]
    is_header = lambda cells: F.array_contains(cells, link) & F.array_contains(cells, brand)
    rows = _by_own_header(_export_records(spark, path, None), is_header, {c: c for c in wanted}, wanted, may_be=_holds(link, brand))
    return brand_mapping(rows, link, brand, date, spellings)


# What the id column of a user list is called, in order of preference.
USER_HEADERS = ("user_id", "external_user_id")


def user_list(spark: SparkSession, users: str | Sequence[str] | None = None, path: str | Sequence[str] | None = None) -> DataFrame:
    """User ids from a comma list or a sequence, or from CSV files at ``path``, by the header each of them has."""
    if (users is None) == (path is None):
        raise ValueError("give either users or path")
    if path is None:
        names = [u.strip() for u in users.split(",") if u.strip()] if isinstance(users, str) else users
        return spark.createDataFrame([(u,) for u in names], "user_id string")
    records = _export_records(spark, path, None)
    named = lambda cells: F.coalesce(*[F.when(F.array_contains(cells, h), F.lit(h)) for h in USER_HEADERS])
    first = _kept(spark, _first_records(records))
    lacking = first.filter(named("_header").isNull()).select(_path(F.col("at")).alias("file_path"), "_header").limit(1).collect()
    if lacking:
        raise ValueError(f"no user_id or external_user_id column in {lacking[0]['file_path']}, only {[c for c in lacking[0]['_header'] if c]}")
    rows = _by_own_header(records, None, {h: h for h in USER_HEADERS}, first=first)
    return rows.select(F.coalesce(*USER_HEADERS).alias("user_id"))


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower: str | None = None, upper: str | None = None, partitions: int = 64,
               **options: str) -> DataFrame:
    """A database table or query, read in parallel ranges of a numeric, date or time column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                                numPartitions=str(partitions))
    return reader.load()


def query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], **parameters) -> DataFrame:
    """A SQL query over the given frames with named ``:parameters``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=parameters or None)
