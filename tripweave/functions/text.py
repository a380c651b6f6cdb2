"""String, URL and geo scalars as Column expressions (no Python per row)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip() and str.split() know it.  An explicit list
# is much faster than a Unicode-aware pattern, and Java's pattern misses some.
WHITE_SPACE = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)))
) + "".join(map(chr, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# The same as a pattern, written as "nothing else": the first range settles
# nearly every character of ordinary text.
_VISIBLE = r"-\x84\x86-\x9f\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff\u3001-\x{10ffff}\x00-\x08\x0e-\x1b"
SPACE_PATTERN = "[^!" + _VISIBLE + "]"
_NOT_BLANK = "[^ " + _VISIBLE + "]"
# Every line boundary str.splitlines() knows.
_LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029]"
# Multi-line, '\n' as the only line end.
_MULTILINE = "(?md)"


def strip(col: Column) -> Column:
    """Trim all Unicode white space (plain ``trim`` only knows U+0020)."""
    return F.trim(col, F.lit(WHITE_SPACE))


def blank_to_null(col: Column) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def is_blank(col: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return blank_to_null(col).isNull()


def first_non_empty(*cols: Column) -> Column:
    """First column with text after stripping, else the empty string."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def collapse_whitespace(col: Column) -> Column:
    """Runs of white space become one blank, ends are trimmed."""
    # Single blanks, the usual case, are no match and stay untouched.
    return F.trim(F.regexp_replace(col, f"{SPACE_PATTERN}{{2,}}|{_NOT_BLANK}", " "))


def or_default(col: Column, default: str) -> Column:
    """``col`` unless it is null or the empty string."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


# --- object names and keys --------------------------------------------------


def safe_object_name(col: Column, default: str = "", lower: bool = False) -> Column:
    """Name usable in an object key: blanks to ``_``, only ``[A-Za-z0-9_-]``."""
    text = F.lower(col) if lower else col
    kept = F.regexp_replace(
        F.replace(strip(text), F.lit(" "), F.lit("_")), r"[^A-Za-z0-9_\-]", ""
    )
    return or_default(kept, default)


def raw_detail_key(city_name_en: Column, ingest_date: Column) -> Column:
    """Raw-zone key of one city file; null when the date is not eight digits."""
    from tripweave.functions.dates import ingest_date_key

    return F.concat(
        F.lit("raw/KR/details/"),
        ingest_date_key(ingest_date),
        F.lit("/"),
        safe_object_name(city_name_en, "UNKNOWN_CITY"),
        F.lit(".json"),
    )


def image_key(
    city: Column, base: Column, suffix: Column, ext: Column, prefix: str = "images/KR"
) -> Column:
    """Image-zone key ``<prefix>/<City>/<Name>_<suffix>.<ext>``."""
    clean_ext = or_default(F.regexp_replace(F.lower(ext), r"^\.+", ""), "jpg")
    return F.concat(
        F.lit(prefix + "/"),
        safe_object_name(F.coalesce(city, F.lit("")), "UNKNOWN"),
        F.lit("/"),
        safe_object_name(F.coalesce(base, F.lit("")), "UNKNOWN"),
        F.lit("_"),
        suffix,
        F.lit("."),
        clean_ext,
    )


# Image types and their media types.
IMAGE_MEDIA_TYPES = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "bmp": "image/bmp",
    "gif": "image/gif",
    "webp": "image/webp",
}


def url_extension(url: Column) -> Column:
    """Extension of the last path segment, query removed; ``jpg`` if none."""
    segment = F.regexp_extract(F.split_part(url, F.lit("?"), F.lit(1)), r"([^/]*)\z", 1)
    return or_default(
        F.regexp_extract(segment, r"\A\.*[^.].*\.([^.]*)\z", 1), "jpg"
    )


def image_extension(url: Column) -> Column:
    """Extension limited to known image types, lower case; else ``jpg``."""
    path = F.regexp_replace(url, r"(?s)[?#].*\z", "")
    ext = F.lower(F.regexp_extract(path, r"\.([^.]*)\z", 1))
    return F.when(ext.isin(*IMAGE_MEDIA_TYPES), ext).otherwise(F.lit("jpg"))


def media_type(ext: Column) -> Column:
    """Media type of an extension, generic binary for unknown ones."""
    clean = F.regexp_replace(F.lower(ext), r"^\.+", "")
    out = F.lit("application/octet-stream")
    for known, kind in IMAGE_MEDIA_TYPES.items():
        out = F.when(clean == known, F.lit(kind)).otherwise(out)
    return out


# --- URLs -------------------------------------------------------------------


def is_valid_url(url: Column) -> Column:
    """http(s) URL made of legal characters only; null counts as invalid."""
    pattern = r"\Ahttps?://[a-zA-Z0-9\-._~:/?#\[\]@!$&'()*+,;=%]+\z"
    return F.coalesce(strip(url).rlike(pattern), F.lit(False))


# Host tokens of official and tourism sites, and excluded ones.
KR_SITE_TOKENS = (".go.kr", "tour.", "tourism", "travel", "kankou")
KR_SITE_BLOCKED = ("blog", "sns", "facebook")
JP_SITE_TOKENS = (".lg.jp", ".or.jp", "city.", "town.", "village.", "kankou", "tourism")
JP_SITE_BLOCKED = ("blog", "sns")


def official_urls(
    urls: Column,
    tokens: Sequence[str] = KR_SITE_TOKENS,
    blocked: Sequence[str] = KR_SITE_BLOCKED,
    limit: int = 2,
) -> Column:
    """First ``limit`` distinct links that look official, in page order."""

    def mentions_any(url: Column, words: Sequence[str]) -> Column:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(F.lower(url), F.lit(word))
        return hit

    wanted = F.filter(
        urls,
        lambda u: (F.length(u) > 0) & mentions_any(u, tokens) & ~mentions_any(u, blocked),
    )
    return F.slice(F.array_distinct(wanted), 1, limit)


def page_url(lang: Column, title: Column) -> Column:
    """Article URL of a title; empty title gives an empty URL."""
    encoded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for found, wanted in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return F.when(
        F.length(title) > 0,
        F.concat(F.lit("https://"), lang, F.lit(".wikipedia.org/wiki/"), encoded),
    ).otherwise(F.lit(""))


def title_from_href(href: Column) -> Column:
    """Article title behind a ``/wiki/`` link, else the empty string."""
    path = F.regexp_replace(href, r"(?s)[?#].*\z", "")
    raw = F.regexp_extract(path, r"(?s)\A.*/wiki/(.*)\z", 1)
    # url_decode also turns '+' into a blank, a path keeps it.
    safe = F.replace(raw, F.lit("+"), F.lit("%2B"))
    return F.replace(F.coalesce(F.try_url_decode(safe), raw), F.lit("_"), F.lit(" "))


# Title prefixes of pages that are no articles.
NON_PAGE_PREFIXES = ("Category:", "File:", "Help:", "Portal:", "Template:", "Wikipedia:")


def is_non_page_title(title: Column) -> Column:
    return title.rlike(r"\A(?:" + "|".join(NON_PAGE_PREFIXES) + ")")


def is_valid_linked_title(lang: Column, title: Column) -> Column:
    """Article title, and for English links one without CJK characters."""
    cjk = title.rlike(r"[\u3040-\u30ff\u3400-\u9fff]")
    return ~is_non_page_title(title) & ~((lang == "en") & cjk)


def linked_title(langlinks: Column, lang: str) -> Column:
    """First valid title in ``array<struct<lang,title>>`` for one language."""
    hits = F.filter(
        langlinks,
        lambda l: (l["lang"] == lang)
        & (F.length(l["title"]) > 0)
        & is_valid_linked_title(F.lit(lang), l["title"]),
    )
    return F.coalesce(F.get(hits, F.lit(0))["title"], F.lit(""))


# --- coordinates ------------------------------------------------------------

# Bounding box of South Korea, degrees.
KR_LON = (124.0, 132.0)
KR_LAT = (33.0, 39.0)


def coordinates(lon: Column, lat: Column) -> Column:
    """``struct<ok,longitude,latitude>`` from raw text.

    Unparsable input nulls both numbers; a point outside the box keeps them.
    """
    x, y = lon.try_cast("double"), lat.try_cast("double")
    parsed = x.isNotNull() & y.isNotNull()
    inside = x.between(*KR_LON) & y.between(*KR_LAT)
    return F.struct(
        F.coalesce(parsed & inside, F.lit(False)).alias("ok"),
        F.when(parsed, x).alias("longitude"),
        F.when(parsed, y).alias("latitude"),
    )


def coordinate_status(lon: Column, lat: Column) -> Column:
    """missing / needs_review / collected for a raw coordinate pair."""
    x, y = lon.try_cast("double"), lat.try_cast("double")
    return (
        F.when(x.isNull() | y.isNull(), F.lit("missing"))
        .when((x == 0) | (y == 0), F.lit("needs_review"))
        .when(x.between(*KR_LON) & y.between(*KR_LAT), F.lit("collected"))
        .otherwise(F.lit("needs_review"))
    )


def dms_to_decimal(deg: Column, minutes: Column, seconds: Column, direction: Column) -> Column:
    """Degrees/minutes/seconds text to signed degrees (S and W negative)."""

    def part(col: Column, unit: int) -> Column:
        absent = F.coalesce(col, F.lit("")) == ""
        return F.when(absent, F.lit(0.0)).otherwise(col.try_cast("double") / unit)

    value = deg.try_cast("double") + part(minutes, 60) + part(seconds, 3600)
    return F.when(direction.isin("S", "W"), -value).otherwise(value)


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often fn uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _dms_pair(text: Column, pattern: str) -> Column:
    def from_groups(groups: Column) -> Column:
        return F.struct(
            dms_to_decimal(*[groups[i] for i in range(4)]).alias("lat"),
            dms_to_decimal(*[groups[i] for i in range(4, 8)]).alias("lon"),
        )

    def extract(t: Column) -> Column:
        groups = F.array(*[F.regexp_extract(t, pattern, i) for i in range(1, 9)])
        return F.when(t.rlike(pattern), bind(groups, from_groups))

    pair = bind(text, extract)
    return F.when(pair["lat"].isNotNull() & pair["lon"].isNotNull(), pair)


# Coordinate notations found in pages.
_GEOHACK_DMS = (
    r"([0-9.]+)_([0-9.]+)?_?([0-9.]+)?_?([NS])_([0-9.]+)_([0-9.]+)?_?([0-9.]+)?_?([EW])"
)
_GEOHACK_DECIMAL = r"(-?\d+(?:\.\d+)?)_([NS])_(-?\d+(?:\.\d+)?)_([EW])"
_TEMPLATE_DMS = (
    r"\{\{좌표\|([0-9.]+)\|([0-9.]+)?\|?([0-9.]+)?\|?([NS])\|"
    r"([0-9.]+)\|([0-9.]+)?\|?([0-9.]+)?\|?([EW])"
)


def _query_params(url: Column) -> Column:
    raw = F.regexp_extract(url, r"[?&]params=([^&#]*)", 1)
    return F.nullif(F.coalesce(F.try_url_decode(raw), raw), F.lit(""))


def geohack_coordinates(url: Column) -> Column:
    """``struct<lat,lon>`` from the ``params`` of a map link, else null."""
    return _dms_pair(F.coalesce(_query_params(url), F.lit("")), _GEOHACK_DMS)


def geohack_href_coordinates(href: Column) -> Column:
    """As above for a raw link: decimal form first, whole link as fallback."""
    return bind(F.coalesce(_query_params(href), href), _link_coordinates)


def _link_coordinates(text: Column) -> Column:
    lat = F.regexp_extract(text, _GEOHACK_DECIMAL, 1).try_cast("double")
    lon = F.regexp_extract(text, _GEOHACK_DECIMAL, 3).try_cast("double")
    south = F.regexp_extract(text, _GEOHACK_DECIMAL, 2) == "S"
    west = F.regexp_extract(text, _GEOHACK_DECIMAL, 4) == "W"
    decimal = F.when(
        lat.isNotNull() & lon.isNotNull(),
        F.struct(
            F.when(south, -lat).otherwise(lat).alias("lat"),
            F.when(west, -lon).otherwise(lon).alias("lon"),
        ),
    )
    return F.coalesce(decimal, _dms_pair(text, _GEOHACK_DMS))


def template_coordinates(content: Column) -> Column:
    """``struct<lat,lon>`` from a coordinate template in page text."""
    return _dms_pair(F.coalesce(content, F.lit("")), _TEMPLATE_DMS)


def geo_decimal(text: Column) -> Column:
    """``struct<lat,lon>`` from the first two numbers of a text."""
    numbers = F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1))
    return F.when(
        F.size(numbers) >= 2,
        F.struct(
            F.get(numbers, F.lit(0)).try_cast("double").alias("lat"),
            F.get(numbers, F.lit(1)).try_cast("double").alias("lon"),
        ),
    )


# --- page text --------------------------------------------------------------

# Disambiguation suffixes dropped from displayed titles.
KR_TITLE_SUFFIXES = ("강원특별자치도", "경상북도", "대한민국")
JP_TITLE_SUFFIXES = ("도쿄도",)

_NEXT_SECTION = f"{_MULTILINE}^=={SPACE_PATTERN}*[^=].*?=={SPACE_PATTERN}*$"


def display_title(title: Column, suffixes: Sequence[str] = KR_TITLE_SUFFIXES) -> Column:
    """Title without a known trailing ``(region)`` qualifier."""
    return strip(F.regexp_replace(title, f"{SPACE_PATTERN}+" + r"\((?:" + "|".join(suffixes) + r")\)\z", ""))


def _heading_pattern(headings: Sequence[str]) -> str:
    names = "|".join(re.escape(h) for h in headings)
    return f"{_MULTILINE}^==+{SPACE_PATTERN}*({names}){SPACE_PATTERN}*==+{SPACE_PATTERN}*$"


def section_content(content: Column, headings: Sequence[str]) -> Column:
    """Text between the first matching heading and the next level-2 heading."""
    after = F.get(F.split(content, _heading_pattern(headings), 2), F.lit(1))
    return F.coalesce(F.get(F.split(after, _NEXT_SECTION, 2), F.lit(0)), F.lit(""))


def section_heading(content: Column, headings: Sequence[str]) -> Column:
    """The heading that ``section_content`` matched, else empty."""
    return F.regexp_extract(content, _heading_pattern(headings), 1)


def strip_templates(text: Column) -> Column:
    """Remove ``{{…}}`` at any nesting depth; an open one swallows the rest."""
    return bind(text, _without_templates)


def _without_templates(text: Column) -> Column:
    mark = "\x01"
    parts = F.split(F.regexp_replace(text, r"\{\{|\}\}", f"{mark}$0{mark}"), mark)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def step(acc: Column, part: Column) -> Column:
        closes = (part == "}}") & (acc["depth"] > 0)
        opens = part == "{{"
        depth = acc["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        keep = (acc["depth"] == 0) & ~opens
        return F.struct(
            depth.cast("int").alias("depth"),
            F.when(keep, F.concat(acc["out"], part)).otherwise(acc["out"]).alias("out"),
        )

    folded = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(F.contains(text, F.lit("{{")), folded).otherwise(text)


def clean_section_text(section: Column) -> Column:
    """Page markup to plain paragraphs joined by an empty line."""
    # The markup patterns removed.
    text = F.regexp_replace(section, r"(?s)\{\|.*?\n\|\}", "")
    text = F.regexp_replace(text, r"(?d)<ref.*?</ref>|<ref[^>]*/>", "")
    text = strip_templates(text)
    text = F.regexp_replace(text, r"\[\[(?:[^|\]]*\|)?([^\]]+)\]\]", "$1")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    text = F.regexp_replace(text, r"'{2,}", "")
    text = F.regexp_replace(text, rf"\({SPACE_PATTERN}*\)", "")

    def reflow(paragraph: Column) -> Column:
        lines = F.transform(F.split(paragraph, _LINE_BREAK), strip)
        kept = F.filter(lines, lambda l: (l != "") & ~l.rlike(r"\A(?:==|[|!{}])"))
        return F.array_join(kept, " ")

    paragraphs = F.transform(F.split(text, rf"\n{SPACE_PATTERN}*\n"), reflow)
    return F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n\n")


def lead_paragraphs(extract: Column) -> Column:
    """Paragraphs of an extract with white space collapsed."""
    parts = F.transform(F.split(extract, rf"\n{SPACE_PATTERN}*\n"), collapse_whitespace)
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")


def lead_from_content(content: Column) -> Column:
    """Cleaned text before the first level-2 heading."""
    return clean_section_text(F.get(F.split(content, _NEXT_SECTION, 2), F.lit(0)))


def table_caption(table: Column) -> Column:
    """Caption of a wikitext table, tags removed."""
    raw = F.regexp_extract(table, _MULTILINE + rf"^\|\+{SPACE_PATTERN}*(.+)$", 1)
    return strip(F.regexp_replace(raw, r"(?d)<.*?>", ""))


# Climate placeholder and heading names.
MANUAL_CLIMATE_CAPTION = "수작업 필요"
MANUAL_CLIMATE_NOTE = "Wikipedia에서 기후 표를 자동 취득하지 못해 수작업 확인이 필요하다."
KR_CLIMATE_HEADINGS = ("기후", "Climate")
JP_CLIMATE_HEADINGS = ("기후", "Climate", "気候")
KR_GEOGRAPHY_HEADINGS = ("지리", "Geography")
JP_GEOGRAPHY_HEADINGS = ("지리", "Geography", "地理")

_WIKI_TABLE = r"(?s)(\{\|.*?\n\|\})"


def manual_climate_table() -> Column:
    """Placeholder map saying that a person has to fill the table in."""
    return F.create_map(
        F.lit("caption"), F.lit(MANUAL_CLIMATE_CAPTION),
        F.lit("wikitext"), F.lit(""),
        F.lit("note"), F.lit(MANUAL_CLIMATE_NOTE),
    )


def climate_table(
    extracted: Column | None,
    content: Column,
    headings: Sequence[str] = KR_CLIMATE_HEADINGS,
) -> Column:
    """``map<string,string>`` of the climate table, null when none is found.

    Order: ready extracted map, table of the climate section, text of that
    section, any table naming the climate.
    """
    section = section_content(content, headings)
    text = clean_section_text(section)
    heading = section_heading(content, headings)
    table = F.regexp_extract(section, _WIKI_TABLE, 1)
    caption = or_default(table_caption(table), "")
    with_table = F.create_map(
        F.lit("caption"), F.when(caption != "", caption).otherwise(heading),
        F.lit("wikitext"), table,
    )
    from_table = F.when(
        text != "", F.map_concat(with_table, F.create_map(F.lit("content"), text))
    ).otherwise(with_table)
    from_text = F.create_map(
        F.lit("caption"), or_default(heading, headings[0]),
        F.lit("wikitext"), F.lit(""),
        F.lit("content"), text,
    )
    tables = F.regexp_extract_all(content, F.lit(_WIKI_TABLE), F.lit(1))
    naming = F.get(
        F.filter(tables, lambda t: t.rlike("|".join(re.escape(h) for h in headings))), F.lit(0)
    )
    from_any = F.create_map(
        F.lit("caption"), or_default(table_caption(naming), headings[0]),
        F.lit("wikitext"), naming,
    )
    found = (
        F.when(table != "", from_table)
        .when(text != "", from_text)
        .when(naming.isNotNull(), from_any)
    )
    return found if extracted is None else F.coalesce(extracted, found)


def climate_status(table: Column) -> Column:
    """missing / needs_review (placeholder) / collected."""
    return (
        F.when(table.isNull() | (F.size(table) == 0), F.lit("missing"))
        .when(
            F.coalesce(F.try_element_at(table, F.lit("caption")), F.lit("")) == MANUAL_CLIMATE_CAPTION,
            F.lit("needs_review"),
        )
        .otherwise(F.lit("collected"))
    )


def section_document(sections: Column) -> Column:
    """Synthetic page text of ``array<struct<heading,paragraphs>>``."""
    kept = F.filter(sections, lambda s: F.size(s["paragraphs"]) > 0)
    return F.array_join(
        F.transform(
            kept,
            lambda s: F.concat(
                F.lit("== "), s["heading"], F.lit(" ==\n"), F.array_join(s["paragraphs"], "\n\n")
            ),
        ),
        "\n\n",
    )


# --- regions, sentences, errors ---------------------------------------------


def detect_region(text: Column, regions: Sequence[tuple[str, Sequence[str], str]]) -> Column:
    """Id of the first region named in ``text``, null when none is.

    ``regions`` holds (id, native names, English name) in priority order.  A
    short fixed list becomes a chain of conditions, so no join is needed.
    Native names match as substrings, the English one on word boundaries.
    """
    def find(t: Column) -> Column:
        lowered = F.lower(t)
        branches = []
        for region_id, native, english in regions:
            # The plain search decides almost always; the pattern only confirms.
            hit = F.contains(lowered, F.lit(english.lower())) & t.rlike(r"(?iU)\b" + re.escape(english) + r"\b")
            for name in native:
                hit = hit | F.contains(t, F.lit(name))
            branches.append(F.when(hit, F.lit(region_id)))
        return F.coalesce(*branches)

    return bind(text, find)


# The sentences of location_text, description_fallback and geography_fallback.
def location_text(country: str, region_name: Column) -> Column:
    return F.when(region_name.isNotNull(), F.concat(F.lit(country + " "), region_name)).otherwise("")


def description_fallback(country: str, title: Column, region_name: Column) -> Column:
    """Sentence used when a page has no lead text."""
    return F.when(
        title != "",
        F.concat(title, F.lit(f"는 {country} "), region_name, F.lit("에 속한 지자체이다.")),
    ).otherwise(F.lit(""))


def geography_fallback(
    country: str, title: Column, region_name: Column, lat: Column, lon: Column
) -> Column:
    """Sentence used when a page has no geography section."""
    head = F.concat(title, F.lit(f"는 {country} "), region_name)
    located = F.concat(
        head, F.lit("에 위치한 지자체이며, 대표 좌표는 위도 "), lat.cast("string"),
        F.lit(", 경도 "), lon.cast("string"), F.lit("이다."),
    )
    return (
        F.when(title == "", F.lit(""))
        .when(lat.isNotNull() & lon.isNotNull(), located)
        .otherwise(F.concat(head, F.lit("에 위치한 지자체이다.")))
    )


# Words that decide the category of an error, first hit wins.
ERROR_KEYWORDS = (
    ("api", ("api", "status code", "401", "403", "429", "500", "502", "503")),
    ("network", ("network", "timeout", "connection", "socket", "dns", "unreachable")),
    ("parsing", ("parse", "json", "decode", "keyerror", "format", "invalid syntax")),
)


def error_category(message: Column) -> Column:
    """api / network / parsing / other, by keyword."""
    lowered = F.lower(message)
    branches = [
        F.when(lowered.rlike("|".join(re.escape(w) for w in words)), F.lit(name))
        for name, words in ERROR_KEYWORDS
    ]
    return F.coalesce(*branches, F.lit("other"))
