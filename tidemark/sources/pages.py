"""File entries out of directory-listing pages."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The form of one entry of a listing, as the published pages have it: month, day, year, hour, minute, AM/PM, size, link
# target, link text. Tag names may have either case, the target either quote or none; `(?U)` lets `\s` match
# no-break spaces, `(?d)` keeps `.` off line feeds only.
_GAP = r"(?:\s|&nbsp;|&#160;|&#[xX][aA]0;)"
_LINK = (
    r"""(?i:<a\s(?:[^>]*\s)?href)\s*=\s*["']?((?<=")[^"]*|(?<=')[^']*|(?<!["'])[^\s"'>]+)["']?[^>]*>(.*?)(?i:</a\s*>)"""
)
FILE_ENTRY = rf"(?Ud)(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_GAP}+(\d{{1,2}}):(\d{{2}}){_GAP}([APM]{{2}}){_GAP}+(\d+){_GAP}+{_LINK}"
FILE_ENTRY_GROUPS = ["_month", "_day", "_year", "_hour", "_minute", "_half", "_size", "_href", "file_name"]
# The groups of a pattern that leaves date and time whole.
DATED_GROUPS = ["_date", "_time", "_size", "_href", "file_name"]
# A piece with a date, a size and a link must be an entry: what does not match would be taken for a removed file.
LIKE_AN_ENTRY = rf"(?iUs)\d{{1,2}}/\d{{1,2}}/\d{{4}}.*\d{_GAP}*<a{_GAP}[^>]*href"

# Any link, on pages cut at the end of links: target and text.
LINK_ENTRY = r"""(?s)<a href="([^"\n]*)">(.*)$"""
LINK_END = r"(?i)</a\s*>"

PRE_BLOCK = r"(?is)<pre\b[^>]*>(.*?)(?:</pre\s*>|\z)"
LINE_BREAK = r"(?i)<br\s*/?>"


def entries(
    pages: DataFrame,
    pattern: str,
    groups: list[str],
    block: str | None = PRE_BLOCK,
    cut: str = LINE_BREAK,
    text: str = "html",
    keep_pages: bool = False,
    like: str | None = None,
) -> DataFrame:
    """Cut each page, by default at its line breaks, and keep the first match of `pattern` in each piece.

    `groups` names the capture groups, of which only the last may match a line feed. All columns but
    the page text are kept. With `keep_pages` each page also gives a row whose groups are NULL, so that
    pages without a match can be seen. Given `like`, a piece that is like an entry but is none gives a row with only the piece, as column
    `_lost`; then a match must begin with a word character. The pattern runs once per piece and once per match.
    """
    keep = [F.col(f"`{c}`") for c in pages.columns if c != text]
    body = F.regexp_extract(text, block, 1) if block else F.col(text)

    one_per_line = "\n".join(f"${i}" for i in range(1, len(groups) + 1))
    nothing = F.lit(None)

    def read(found: Column) -> Column:
        cells = F.split(F.regexp_replace(found, pattern, one_per_line), "\n", len(groups))
        if like is None:
            return F.struct(cells.alias("cells"), nothing.cast("string").alias("lost"))
        is_lost = F.startswith(found, F.lit(_LOST))
        lost = F.when(is_lost, F.substring(found, len(_LOST) + 1, 200))
        return F.struct(F.when(~is_lost, cells).alias("cells"), lost.alias("lost"))

    def match(piece: Column) -> Column:
        found = F.regexp_extract(piece, pattern, 0)
        if like is None:
            return found
        return F.when((found == "") & piece.rlike(like), F.concat(F.lit(_LOST), F.substring(piece, 1, 200))).otherwise(found)

    pieces = F.split(body, cut)
    if keep_pages:  # also of a page without text
        pieces = F.concat(F.array(nothing.cast("string")), F.coalesce(pieces, F.array().cast("array<string>")))
    # Pieces and their cells are made by generators: no filter that is pushed down repeats the patterns, and a page holds no more than its pieces.
    found = F.filter(F.transform(F.array("_piece"), match), lambda m: m.isNull() | (m != ""))
    matches = pages.select(*keep, F.explode(pieces).alias("_piece")).select(*keep, F.explode(F.transform(found, read)).alias("_match"))
    lost = [] if like is None else [F.col("_match.lost").alias("_lost")]
    return matches.select(*keep, *[F.col("_match.cells")[i].alias(name) for i, name in enumerate(groups)], *lost)


# Marks a piece that was not read.
_LOST = "!"


def decode_references(c: Column) -> Column:
    """Text with its character references as characters; an unknown one stays as it is."""
    known = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))])

    def with_code(part: Column) -> Column:
        name = F.regexp_extract(part, r"^&#?[xX]?(\w+);$", 1)
        code = F.when(part.rlike(r"^&#[0-9]{1,7};$"), name.try_cast("int"))
        code = F.when(part.rlike(r"^&#[xX][0-9a-fA-F]{1,6};$"), F.conv(name, 16, 10).try_cast("int")).otherwise(code)
        return F.struct(part.alias("part"), name.alias("name"), code.alias("code"))

    def decode(read: Column) -> Column:
        part, code = read["part"], read["code"]
        legal = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(legal, character).when(part.rlike(r"^&\w+;$"), F.coalesce(known[read["name"]], part)).otherwise(part)

    parts = F.regexp_extract_all(c, F.lit(r"&#?\w+;|[^&]+|&"), F.lit(0))
    decoded = F.transform(F.transform(parts, with_code), decode)
    return F.when(F.contains(c, F.lit("&")), F.array_join(decoded, "")).otherwise(c)


def page_parts(spark: SparkSession, path: str | list[str], line_break: str = "<br>") -> DataFrame:
    """`(page_file, html)`: what stands in the first `<pre>` block of each page, one page to a file, in parts that end at line breaks.

    Files are read with `line_break` between records, so a page of any size splits, and no entry is cut. Where the block begins and ends
    in a file is found first, by an aggregate over places; then each part knows by its own place whether it is inside. Pages that write the break
    otherwise give the same entries, but in larger parts. A page without the block gives no part. The files are read twice.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    parts = spark.read.option("lineSep", line_break).text(path)
    parts = parts.select(F.col("_metadata.file_path").alias("page_file"), place.alias("at"), F.col("value").alias("html"))
    opening, closing = r"(?i)<pre\b[^>]*>", r"(?i)</pre\s*>"
    opened = parts.where(F.col("html").rlike(opening)).groupBy("page_file")
    shut = F.col("html").rlike(r"(?is)\A.*?<pre\b[^>]*>.*?</pre\s*>")
    opened = opened.agg(F.min(F.struct("at", shut.alias("shut"))).alias("open")).select("page_file", "open.*").withColumnRenamed("at", "opens")
    closes = parts.where(F.col("html").rlike(closing)).join(opened, "page_file").where("at > opens and not shut")
    closes = closes.groupBy("page_file").agg(F.min("at").alias("closes"))
    # One row per page, whose parts stay with the task that reads them: a shuffle by page would leave few pages to few tasks.
    inside = parts.join(F.broadcast(opened.join(closes, "page_file", "left")), "page_file")
    inside = inside.where("at = opens or at > opens and not shut and (closes is null or at <= closes)")
    body = F.when(F.col("at") == F.col("opens"), F.regexp_extract("html", PRE_BLOCK, 1))
    body = body.when(F.col("at") == F.col("closes"), F.regexp_extract("html", r"(?is)\A(.*?)</pre\s*>", 1)).otherwise(F.col("html"))
    return inside.select("page_file", body.alias("html"))


def _clock(raw: DataFrame) -> DataFrame:
    """Date and time cells of `DATED_GROUPS` as the pieces of `FILE_ENTRY_GROUPS`."""
    date = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$"
    time = r"(?U)^\s*(\d{1,2}):(\d{2})\s*([APM]{2})\s*$"
    pieces = {n: F.regexp_extract("_date", date, i + 1) for i, n in enumerate(FILE_ENTRY_GROUPS[:3])}
    pieces |= {n: F.regexp_extract("_time", time, i + 1) for i, n in enumerate(FILE_ENTRY_GROUPS[3:6])}
    return raw.withColumns(pieces).drop("_date", "_time")


def extract_listing(
    pages: DataFrame,
    base_url: str,
    pattern: str = FILE_ENTRY,
    keep_pages: bool = False,
    groups: list[str] | None = None,
    block: str | None = PRE_BLOCK,
) -> DataFrame:
    """The files named on listing pages.

    Sub-directories and the parent link carry no size, do not match and drop out; so does
    a page without a `<pre>` block. Any other piece with a date, a size and a link must match; one that does not
    fails the job, and so does an impossible date, time or size. Character references in names and targets are decoded. The timestamp
    text is padded piece by piece, so no time zone can shift it; columns of `pages` such as `run_ts` are kept. With
    `keep_pages` each page gives one more row without a file name.

    A pattern of one's own has the groups of `FILE_ENTRY_GROUPS`, or those named in `groups`, such as `DATED_GROUPS`. A page is
    one row, so it is read by one task; pages of any size are read by many from files (`page_parts`, with no `block`).
    """
    found = parse_listing(pages, base_url, pattern, keep_pages, groups, block)
    readable = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem"))).otherwise(F.lit(True))
    return found.where(readable).drop("problem")


def parse_listing(
    pages: DataFrame,
    base_url: str,
    pattern: str = FILE_ENTRY,
    keep_pages: bool = False,
    groups: list[str] | None = None,
    block: str | None = PRE_BLOCK,
) -> DataFrame:
    """The same without failing: `problem` says what could not be read, and is NULL for a good entry."""
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in ("html", "url")]
    own = pattern != FILE_ENTRY
    groups = groups or FILE_ENTRY_GROUPS
    like = None if own else LIKE_AN_ENTRY
    raw = entries(pages.drop("url"), pattern, groups, block=block, keep_pages=keep_pages, like=like)
    if own:
        raw = raw.withColumn("_lost", F.lit(None).cast("string"))
    if "_date" in groups:
        raw = _clock(raw)
    month, day, year, hour, minute, half = (F.col(g) for g in FILE_ENTRY_GROUPS[:6])
    written = F.format_string("%s/%s/%s %s:%s %s", month, day, year, hour, minute, half)
    two = [F.lpad(part, 2, "0") for part in (month, day, hour)]
    padded = F.concat(
        two[0], F.lit("/"), two[1], F.lit("/"), year, F.lit(" "), two[2], F.lit(":"), minute, F.lit(" "), half
    )
    on_clock = hour.try_cast("int").between(1, 12) & half.isin("AM", "PM")
    past_noon = F.when(half == "PM", 12).otherwise(0)
    parsed = F.try_make_timestamp_ntz(
        year.try_cast("int"),
        month.try_cast("int"),
        day.try_cast("int"),
        F.when(on_clock, hour.try_cast("int") % 12 + past_noon),
        minute.try_cast("int"),
        F.lit(0),
    )
    size = F.col("_size").try_cast("bigint")
    problem = (
        F.when(F.col("_lost").isNotNull(), F.concat(F.lit("not read as an entry: "), F.col("_lost")))
        .when(F.col("file_name").isNotNull() & parsed.isNull(), F.concat(F.lit("no such time: "), written))
        .when(F.col("file_name").isNotNull() & size.isNull(), F.concat(F.lit("no such size: "), F.col("_size")))
    )
    return raw.select(
        *keep,
        decode_references(F.col("file_name")).alias("file_name"),
        F.when(parsed.isNotNull(), padded).alias("file_timestamp"),
        F.concat(F.lit(base_url), decode_references(F.col("_href"))).alias("full_url"),
        parsed.alias("file_ts"),
        size.alias("file_size"),
        problem.alias("problem"),
    )
