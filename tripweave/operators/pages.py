"""Encyclopedia pages to structured pages and city records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import text as X
from tripweave.functions.html import html_elements
from tripweave.functions.names import city_id
from tripweave.operators.quality import COLLECTED, MISSING, NEEDS_REVIEW, field_status
from tripweave.sources import fixed
from tripweave.sources.dimensions import prefecture_regions, province_regions, tokyo_korean_name

_FOOTNOTE = r"\[\d+\]"


def _has_class(element: Column, name: str) -> Column:
    return F.array_contains(F.split(F.coalesce(element["css"], F.lit("")), r"\s+"), name)


def _first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _tagged(elements: Column, *tags: str) -> Column:
    return F.filter(elements, lambda e: e["tag"].isin(*tags))


def _legacy_sections(elements: Column) -> tuple[Column, Column]:
    """Lead and sections of a page whose paragraphs follow flat headings."""
    top = F.filter(elements, lambda e: e["top"])

    def heading(h: Column) -> Column:
        headline = _first(F.filter(elements, lambda e: _has_class(e, "mw-headline") & (e["up"] == h["n"])))
        return F.struct(
            h["n"].alias("n"), X.collapse_whitespace(F.coalesce(headline["text"], h["text"])).alias("heading")
        )

    headings = F.filter(F.transform(_tagged(top, "h2"), heading), lambda h: h["heading"] != "")
    paragraphs = F.filter(
        F.transform(
            _tagged(top, "p"), lambda p: F.struct(p["n"].alias("n"), X.collapse_whitespace(p["text"]).alias("text"))
        ),
        lambda p: p["text"] != "",
    )
    first = F.coalesce(_first(headings)["n"], F.lit(2**31 - 1))
    lead = F.transform(F.filter(paragraphs, lambda p: p["n"] < first), lambda p: p["text"])

    def section(h: Column, i: Column) -> Column:
        end = F.coalesce(F.get(headings, i + 1)["n"], F.lit(2**31 - 1))
        own = F.filter(paragraphs, lambda p: (p["n"] > h["n"]) & (p["n"] < end))
        return F.struct(h["heading"].alias("heading"), F.transform(own, lambda p: p["text"]).alias("paragraphs"))

    return lead, F.transform(headings, section)


def _nested_sections(elements: Column) -> tuple[Column, Column]:
    """Lead and sections of a page built from ``<section>`` elements."""
    sections = F.filter(_tagged(elements, "section"), lambda e: e["top"])

    def section(s: Column) -> Column:
        inside = F.filter(elements, lambda e: e["section"] == s["n"])
        paragraphs = F.filter(
            F.transform(_tagged(inside, "p"), lambda p: X.collapse_whitespace(p["text"])), lambda t: t != ""
        )
        title = X.collapse_whitespace(F.coalesce(_first(_tagged(inside, "h2"))["text"], s["href"], F.lit("")))
        is_lead = F.coalesce(s["label"] == "0", F.lit(False))
        return F.struct(is_lead.alias("is_lead"), title.alias("heading"), paragraphs.alias("paragraphs"))

    parsed = F.transform(sections, section)
    lead = F.flatten(F.transform(F.filter(parsed, lambda s: s["is_lead"]), lambda s: s["paragraphs"]))
    body = F.filter(parsed, lambda s: ~s["is_lead"] & (s["heading"] != "") & (F.size(s["paragraphs"]) > 0))
    return lead, F.transform(
        body, lambda s: F.struct(s["heading"].alias("heading"), s["paragraphs"].alias("paragraphs"))
    )


def _coordinates(elements: Column) -> Column:
    """Decimal coordinates shown on the page, else those of a map link."""
    has_body = F.exists(elements, lambda e: e["in_body"])
    marked = _first(
        F.filter(elements, lambda e: _has_class(e, "geo-dec") & (e["in_body"] | ~has_body))
    )
    links = F.filter(elements, lambda e: (e["tag"] == "a") & F.contains(e["href"], F.lit("geohack")))
    linked = F.transform(links, lambda e: X.geohack_href_coordinates(e["href"]))
    return F.coalesce(
        X.geo_decimal(F.coalesce(marked["text"], F.lit(""))),
        _first(F.filter(linked, lambda c: c.isNotNull())),
    )


def _climate_element(elements: Column) -> Column:
    """First data table with months and climate words."""

    def is_climate(e: Column) -> Column:
        words = F.contains(e["text"], F.lit("월")) & e["text"].rlike("기온|강수량|기후")
        return (e["tag"] == "table") & words & _has_class(e, "wikitable")

    return _first(F.filter(elements, is_climate))


def _table_rows(elements: Column, table: Column) -> Column:
    """Rows of a table: array of cell arrays (tag, text, colspan, rowspan)."""
    rows = F.filter(elements, lambda e: (e["tag"] == "tr") & (e["in_table"] == table["n"]))

    def cells(row: Column) -> Column:
        own = F.filter(elements, lambda e: e["tag"].isin("th", "td") & (e["up"] == row["n"]))
        return F.transform(
            own,
            lambda c: F.struct(
                c["tag"].alias("tag"), c["tight"].alias("text"),
                c["colspan"].alias("colspan"), c["rowspan"].alias("rowspan"),
            ),
        )

    return F.filter(F.transform(rows, cells), lambda r: F.size(r) > 0)


def _table_caption(elements: Column, table: Column) -> tuple[Column, Column]:
    """(own caption or null, caption with the heading above as fallback)."""
    own = _first(F.filter(elements, lambda e: (e["tag"] == "caption") & (e["in_table"] == table["n"])))["tight"]
    above = F.filter(elements, lambda e: e["tag"].isin("h2", "h3") & (e["n"] < table["n"]))
    nearest = F.get(above, F.size(above) - 1)["tight"]
    shown = F.coalesce(F.nullif(own, F.lit("")), nearest, F.lit("기후"))
    return own, F.regexp_replace(shown, _FOOTNOTE, "")


def table_wikitext(table: Column, caption: Column, rows: Column) -> Column:
    """Wikitext of a table element, its own caption and its cell rows."""
    css = F.when(F.coalesce(table["css"], F.lit("")) != "", F.concat(F.lit(' class="'), table["css"], F.lit('"')))

    def cell(c: Column) -> Column:
        attrs = F.array_compact(
            F.array(
                *[
                    F.when(
                        F.coalesce(c[n], F.lit("")) != "", F.concat(F.lit(f'{n}="'), c[n], F.lit('"'))
                    )
                    for n in ("colspan", "rowspan")
                ]
            )
        )
        lead = F.when(F.size(attrs) > 0, F.concat(F.array_join(attrs, " "), F.lit(" | "))).otherwise("")
        return F.concat(lead, F.regexp_replace(c["text"], _FOOTNOTE, ""))

    def line(row: Column) -> Column:
        texts = F.transform(row, cell)
        header = F.forall(row, lambda c: c["tag"] == "th")
        return F.concat(
            F.lit("|-\n"),
            F.when(header, F.concat(F.lit("! "), F.array_join(texts, " !! "))).otherwise(
                F.concat(F.lit("| "), F.array_join(texts, " || "))
            ),
        )

    parts = F.array_compact(
        F.array(
            F.concat(F.lit("{|"), F.coalesce(css, F.lit(""))),
            F.when(caption.isNotNull(), F.concat(F.lit("|+ "), caption)),
            F.nullif(F.array_join(F.transform(rows, line), "\n"), F.lit("")),
            F.lit("|}"),
        )
    )
    return F.array_join(parts, "\n")


def climate_label(cell: Column) -> Column:
    """Row label without footnotes and units."""
    # The units.
    label = F.regexp_replace(F.regexp_replace(cell, _FOOTNOTE, ""), r"\u00a0", " ")
    label = F.regexp_replace(
        label, r"(?U)\s*\([^)]*(?:°C|°F|mm|%|일|inch|인치|센티미터|m|ft)[^)]*\)", ""
    )
    return X.strip(F.regexp_replace(label, r"(?U)\s*(?:°C|°F|mm|%)\b", ""))


def climate_value(cell: Column) -> Column:
    """First number of a cell with a plain minus sign, else its text."""
    clean = F.translate(F.regexp_replace(cell, _FOOTNOTE, ""), "−,", "-")
    number = F.regexp_extract(clean, r"(-?\d+(?:\.\d+)?)", 1)
    return F.when(number != "", number).otherwise(clean)


def climate_cells(rows: Column) -> Column:
    """array<struct<month,label,value>> of a climate table's cell rows.

    The header is the first row naming January and December; its columns from
    January on are the months (and yearly columns, if any).
    """
    numbered = F.transform(
        rows,
        lambda r, i: F.struct(
            i.cast("int").alias("at"), F.transform(r, lambda c: c["text"]).alias("texts")
        ),
    )
    header = _first(
        F.filter(
            numbered,
            lambda r: F.array_contains(r["texts"], "1월") & F.array_contains(r["texts"], "12월"),
        )
    )
    start = _first(
        F.filter(
            F.transform(header["texts"], lambda t, i: F.when(F.contains(t, F.lit("1월")), i.cast("int"))),
            lambda i: i.isNotNull(),
        )
    )
    months = F.slice(header["texts"], start + 1, F.size(header["texts"]) - start)
    later = F.filter(
        numbered, lambda r: (r["at"] > header["at"]) & (F.size(r["texts"]) >= F.size(months))
    )

    def row_cells(r: Column) -> Column:
        return F.filter(
            F.transform(
                months,
                lambda m, i: F.struct(
                    X.strip(F.regexp_replace(m, _FOOTNOTE, "")).alias("month"),
                    climate_label(_first(r["texts"])).alias("label"),
                    climate_value(F.get(r["texts"], start + i.cast("int"))).alias("value"),
                ),
            ),
            lambda c: c["value"].isNotNull(),
        )

    return F.flatten(F.transform(later, row_cells))


def parse_pages(pages: DataFrame, html: str = "html", fallback_title: Column | None = None) -> DataFrame:
    """Adds the structured page to rows with an ``html`` column.

    New columns: title, extract, coordinates, extlinks, langlinks,
    climate_table, climate_data and content (the section document).
    """
    fallback = fallback_title if fallback_title is not None else F.lit("")
    carried = [c for c in pages.columns if c != html]
    parsed = pages.select(*carried, fallback.alias("_fallback"), html_elements(html).alias("_e"))
    e = F.col("_e")
    table = _climate_element(e)
    staged = parsed.withColumn("_table", table)
    staged = staged.withColumn("_rows", _table_rows(e, F.col("_table")))
    own_caption, caption = _table_caption(e, F.col("_table"))
    staged = staged.withColumn("_own_caption", own_caption).withColumn("_caption", caption)

    nested = F.exists(e, lambda x: (x["tag"] == "section") & x["in_body"])
    (flat_lead, flat_sections), (deep_lead, deep_sections) = _legacy_sections(e), _nested_sections(e)
    heading = _first(F.filter(_tagged(e, "h1"), lambda h: h["id"] == "firstHeading"))["text"]
    links = F.filter(_tagged(e, "a"), lambda a: a["href"].isNotNull())
    external = F.filter(F.transform(links, lambda a: a["href"]), lambda h: h.rlike(r"\Ahttps?://"))
    languages = F.transform(
        F.filter(links, lambda a: a["lang"].isNotNull()),
        lambda a: F.struct(a["lang"].alias("lang"), X.title_from_href(a["href"]).alias("title")),
    )
    has_table = F.col("_table").isNotNull()
    climate = F.create_map(
        F.lit("caption"), F.col("_caption"),
        F.lit("wikitext"), table_wikitext(F.col("_table"), F.col("_own_caption"), F.col("_rows")),
    )
    return staged.select(
        *carried,
        F.coalesce(F.nullif(X.collapse_whitespace(F.coalesce(heading, F.lit(""))), F.lit("")), "_fallback").alias("title"),
        F.array_join(F.when(nested, deep_lead).otherwise(flat_lead), "\n\n").alias("extract"),
        _coordinates(e).alias("coordinates"),
        F.array_distinct(external).alias("extlinks"),
        F.array_distinct(F.filter(languages, lambda l: l["title"] != "")).alias("langlinks"),
        F.when(has_table, climate).alias("climate_table"),
        F.when(has_table, climate_cells(F.col("_rows"))).alias("climate_data"),
        X.section_document(F.when(nested, deep_sections).otherwise(flat_sections)).alias("content"),
    )


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct external links without a full parse: (…, extlinks)."""
    hrefs = F.regexp_extract_all(html, F.lit(r"""<a\s[^>]*?href=["'](https?://[^"']*)["']"""), F.lit(1))
    return pages.select(
        *[c for c in pages.columns if c != html], F.array_distinct(hrefs).alias("extlinks")
    )


# --- city records -----------------------------------------------------------


def city_field_status(korean_only: bool, has_korean_page: Column | None = None) -> Column:
    """Status map of a page-built city record.

    A description always needs review.  Korean-only records never have a
    Japanese name; otherwise a Korean name without a Korean page needs review.
    """
    ko = field_status(F.col("city_name_ko"))
    if has_korean_page is not None:
        named = F.coalesce("city_name_ko", F.lit("")) != ""
        ko = F.when(named & ~has_korean_page, F.lit(NEEDS_REVIEW)).otherwise(ko)
    ja = F.lit(MISSING) if korean_only else field_status(F.col("city_name_ja"))
    sites = F.when(F.col("site_urls").isNull(), F.lit(MISSING)).otherwise(F.lit(COLLECTED))
    entries = {
        "city_name_ko": ko,
        "city_name_ja": ja,
        **{
            n: field_status(F.col(n))
            for n in ("city_name_en", "prefecture_id", "location", "latitude", "longitude")
        },
        "description": field_status(F.col("description"), review_if_present=True),
        "geography_description": field_status(F.col("geography_description")),
        "climate_table": X.climate_status(F.col("climate_table")),
        "site_urls": sites,
    }
    return F.create_map(*[x for name, col in entries.items() for x in (F.lit(name), col)])


def _region_names(regions: Sequence[tuple], region_id: Column) -> Column:
    names = F.create_map(*[x for r in regions for x in (F.lit(r[0]), F.lit(r[1]))])
    return F.try_element_at(names, region_id)


def _known_region(regions: Sequence[tuple], given: Column, detected: Column) -> Column:
    """The given region id when it exists, else the detected one."""
    return F.when(given.isin(*[r[0] for r in regions]), given).otherwise(detected)


def _link_coordinates(links: Column) -> Column:
    hits = F.transform(
        F.filter(links, lambda u: F.contains(u, F.lit("geohack"))), X.geohack_coordinates
    )
    return _first(F.filter(hits, lambda c: c.isNotNull()))


def _page_climate() -> Column:
    """Climate map of a parsed page; the cells of its table are the JSON list under ``data``."""
    cells = F.when(
        F.size("climate_data") > 0, F.create_map(F.lit("data"), F.to_json("climate_data"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    own = F.map_concat(F.col("climate_table"), cells)
    return F.coalesce(X.climate_table(own, F.col("content")), X.manual_climate_table())


def climate_data(table: Column) -> Column:
    """The cells (month, label, value) stored with a climate map, null without any."""
    return F.from_json(
        F.try_element_at(table, F.lit("data")), "array<struct<month:string,label:string,value:string>>"
    )


def korean_city_records(pages: DataFrame, english_names: DataFrame, collected_at: Column) -> DataFrame:
    """City records from parsed Korean pages (with ``prefecture_id`` of the
    target, '' when unknown).

    ``english_names`` is (city_name_ko, city_name_en), one row per name.
    """
    source_title = F.coalesce("title", F.lit(""))
    staged = pages.withColumn("city_name_ko", X.display_title(source_title))
    by_title = english_names.select(
        F.col("city_name_ko").alias("title"), F.col("city_name_en").alias("_by_title")
    )
    staged = staged.join(english_names, "city_name_ko", "left").join(by_title, "title", "left")
    text = F.concat_ws("\n", "extract", "title")
    region = _known_region(
        fixed.PROVINCES, F.col("prefecture_id"), X.detect_region(text, province_regions())
    )
    staged = staged.withColumn("_region", region).withColumn(
        "_at",
        F.coalesce("coordinates", _link_coordinates(F.col("extlinks")), X.template_coordinates(F.col("content"))),
    )
    known = F.coalesce(_region_names(fixed.PROVINCES, F.col("_region")), F.lit("한국"))
    title = F.col("city_name_ko")
    lead = F.coalesce(
        F.nullif(X.lead_paragraphs(F.col("extract")), F.lit("")),
        F.nullif(X.lead_from_content(F.col("content")), F.lit("")),
        X.description_fallback("대한민국", title, known),
    )
    geography = F.coalesce(
        F.nullif(X.clean_section_text(X.section_content(F.col("content"), X.KR_GEOGRAPHY_HEADINGS)), F.lit("")),
        X.geography_fallback("대한민국", title, known, F.col("_at.lat"), F.col("_at.lon")),
    )
    climate = _page_climate()
    name_en = F.coalesce(F.nullif("city_name_en", F.lit("")), F.nullif("_by_title", F.lit("")), F.lit(""))
    records = staged.select(
        city_id(F.col("_region"), name_en, title).alias("city_id"),
        "city_name_ko",
        F.lit("").alias("city_name_ja"),
        name_en.alias("city_name_en"),
        F.coalesce("_region", F.lit("")).alias("prefecture_id"),
        X.location_text("대한민국", _region_names(fixed.PROVINCES, F.col("_region"))).alias("location"),
        F.col("_at.lat").alias("latitude"),
        F.col("_at.lon").alias("longitude"),
        lead.alias("description"),
        geography.alias("geography_description"),
        climate.alias("climate_table"),
        X.official_urls(F.col("extlinks")).alias("site_urls"),
        F.lit("Wikipedia").alias("source_name"),
        X.page_url(F.lit("ko"), F.col("title")).alias("source_url"),
        collected_at.alias("collected_at"),
        F.when(F.col("_region").isNotNull() & F.col("_at").isNotNull(), F.lit("medium"))
        .otherwise(F.lit("low"))
        .alias("data_confidence"),
    )
    return records.withColumn("field_status", city_field_status(korean_only=True))


def japanese_city_records(pages: DataFrame, collected_at: Column) -> DataFrame:
    """City records from the page structs ``source``, ``ko``, ``ja``, ``en``.

    ``pages`` also has ``lang`` (of the source page), ``prefecture_id`` and the
    four structs with title, extract, coordinates, extlinks and content.
    """
    order = ("source", "ko", "ja", "en")
    blank = F.lit("")

    def part(page: str, name: str) -> Column:
        return F.coalesce(F.col(page)[name], blank)

    from_ko = F.col("lang") == "ko"
    source_ko = F.when(from_ko, part("source", "title")).otherwise(blank)
    title = X.display_title(
        F.coalesce(
            F.nullif(part("ko", "title"), blank),
            F.nullif(source_ko, blank),
            tokyo_korean_name(part("source", "title")),
        ),
        X.JP_TITLE_SUFFIXES,
    )
    texts = F.concat_ws("\n", *[part(p, "extract") for p in ("ko", "ja", "en", "source")], part("source", "title"))
    region = _known_region(
        fixed.PREFECTURES, F.col("prefecture_id"), X.detect_region(texts, prefecture_regions())
    )
    located = F.coalesce(
        *[F.col(p)["coordinates"] for p in order], *[X.template_coordinates(part(p, "content")) for p in order]
    )
    staged = pages.withColumn("city_name_ko", title).withColumn("_region", region).withColumn("_at", located)
    title = F.col("city_name_ko")
    own_extract = F.coalesce(
        F.nullif(part("ko", "extract"), blank), F.when(from_ko, part("source", "extract")), blank
    )
    own_content = F.coalesce(
        F.nullif(part("ko", "content"), blank), F.when(from_ko, part("source", "content")), blank
    )
    description = F.coalesce(
        F.nullif(X.lead_paragraphs(own_extract), blank),
        F.nullif(X.lead_from_content(own_content), blank),
        X.description_fallback("일본", title, F.lit("도쿄도")),
    )

    def geography(page: str) -> Column:
        section = X.section_content(part(page, "content"), X.JP_GEOGRAPHY_HEADINGS)
        return F.nullif(X.clean_section_text(section), blank)

    climate = F.coalesce(
        *[X.climate_table(None, part(p, "content"), X.JP_CLIMATE_HEADINGS) for p in order],
        X.manual_climate_table(),
    )
    none = F.array().cast("array<string>")
    links = F.concat(*[F.coalesce(F.col(p)["extlinks"], none) for p in order])
    id_name = F.coalesce(F.nullif(part("en", "title"), blank), part("ko", "title"))
    records = staged.select(
        city_id(F.col("_region"), id_name, title, "JP-UNKNOWN").alias("city_id"),
        "city_name_ko",
        part("ja", "title").alias("city_name_ja"),
        part("en", "title").alias("city_name_en"),
        F.coalesce("_region", blank).alias("prefecture_id"),
        X.location_text("일본", _region_names(fixed.PREFECTURES, F.col("_region"))).alias("location"),
        F.col("_at.lat").alias("latitude"),
        F.col("_at.lon").alias("longitude"),
        description.alias("description"),
        F.coalesce(
            geography("ko"),
            geography("source"),
            X.geography_fallback("일본", title, F.lit("도쿄도"), F.col("_at.lat"), F.col("_at.lon")),
        ).alias("geography_description"),
        climate.alias("climate_table"),
        X.official_urls(links, X.JP_SITE_TOKENS, X.JP_SITE_BLOCKED).alias("site_urls"),
        F.lit("Wikipedia").alias("source_name"),
        X.page_url(F.col("lang"), part("source", "title")).alias("source_url"),
        collected_at.alias("collected_at"),
        F.when(F.col("_region").isNotNull() & F.col("_at").isNotNull(), F.lit("medium"))
        .otherwise(F.lit("low"))
        .alias("data_confidence"),
        (part("ko", "title") != "").alias("_has_ko"),
    )
    status = city_field_status(korean_only=False, has_korean_page=F.col("_has_ko"))
    return records.withColumn("field_status", status).drop("_has_ko")


def region_records(cities: DataFrame, regions: DataFrame, id_column: str) -> DataFrame:
    """One region record per region that has cities, in id order.

    The last city by id gives the source URL and collection time.
    """
    latest = cities.groupBy(F.col("prefecture_id").alias(id_column)).agg(
        F.max_by(F.struct("source_url", "collected_at"), F.col("city_id")).alias("at")
    )
    named = regions.join(latest, id_column)
    has_ja = "name_ja" in regions.columns
    ja = F.col("name_ja") if has_ja else F.lit("")
    names = ("prefecture_id", "name_ko", "name_ja", "name_en", "region")
    status = {n: F.lit(COLLECTED) for n in names}
    status["name_ja"] = F.when(ja == "", F.lit(MISSING)).otherwise(F.lit(COLLECTED))
    return named.select(
        F.col(id_column).alias("prefecture_id"), "name_ko", ja.alias("name_ja"), "name_en", "region",
        F.lit("Wikipedia").alias("source_name"), "at.source_url", "at.collected_at",
        F.create_map(*[x for n in names for x in (F.lit(n), status[n])]).alias("field_status"),
        F.lit("medium").alias("data_confidence"),
    ).orderBy("prefecture_id")


def region_page_records(
    pages: DataFrame, regions: DataFrame, id_column: str, lang: str, collected_at: Column
) -> DataFrame:
    """Full region records from their parsed pages (with the region's id), in id order.

    Description, geography, climate and coordinates come from the page; what it
    does not have stays empty, a missing climate table becomes the placeholder.
    """
    blank = F.lit("")
    section = X.section_content(F.col("content"), X.KR_GEOGRAPHY_HEADINGS)
    at = F.coalesce("coordinates", _link_coordinates(F.col("extlinks")), X.template_coordinates(F.col("content")))
    has_ja = "name_ja" in regions.columns
    named = regions.select(
        F.col(id_column).alias("prefecture_id"), "name_ko", (F.col("name_ja") if has_ja else blank).alias("name_ja"),
        "name_en", "region",
    )
    staged = pages.withColumn("_at", at).join(named, "prefecture_id")
    records = staged.select(
        *named.columns,
        F.col("_at.lat").alias("latitude"),
        F.col("_at.lon").alias("longitude"),
        F.coalesce(
            F.nullif(X.lead_paragraphs(F.col("extract")), blank), X.lead_from_content(F.col("content")), blank
        ).alias("description"),
        X.clean_section_text(section).alias("geography_description"),
        _page_climate().alias("climate_table"),
        F.lit("Wikipedia").alias("source_name"),
        X.page_url(F.lit(lang), F.col("title")).alias("source_url"),
        collected_at.alias("collected_at"),
        F.lit("medium").alias("data_confidence"),
    )
    return records.withColumn("field_status", region_field_status()).orderBy("prefecture_id")


def region_field_status() -> Column:
    """Status map of a full prefecture record."""
    plain = ("prefecture_id", "name_ko", "name_ja", "name_en", "region", "latitude", "longitude")
    entries = {n: field_status(F.col(n)) for n in plain}
    entries["description"] = field_status(F.col("description"), review_if_present=True)
    entries["geography_description"] = field_status(F.col("geography_description"))
    entries["climate_table"] = X.climate_status(F.col("climate_table"))
    return F.create_map(*[x for n, col in entries.items() for x in (F.lit(n), col)])


def inherit_climate(cities: DataFrame, regions: DataFrame) -> DataFrame:
    """Cities without a collected climate table take the one of their region.

    Both inputs have climate_table and field_status; ``regions`` is one row per
    prefecture_id with name_ko and source_url.
    """

    def collected(table: Column, status: Column) -> Column:
        caption = F.coalesce(F.try_element_at(table, F.lit("caption")), F.lit(""))
        return F.coalesce(
            (F.size(table) > 0)
            & (F.try_element_at(status, F.lit("climate_table")) == COLLECTED)
            & (caption != X.MANUAL_CLIMATE_CAPTION),
            F.lit(False),
        )

    usable = regions.where(collected(F.col("climate_table"), F.col("field_status"))).select(
        "prefecture_id",
        F.struct("climate_table", "name_ko", "source_url").alias("_region"),
    )
    joined = cities.join(usable, "prefecture_id", "left")
    region = F.col("_region")
    # The note and the names of the entries.
    note = F.concat(
        F.col("city_name_ko"), F.lit("의 개별 기후 표가 없어 "), region["name_ko"],
        F.lit(" 기후 표를 공통 기준으로 적용했다."),
    )
    origin = F.create_map(
        F.lit("source_scope"), F.lit("prefecture"),
        F.lit("source_prefecture_id"), F.col("prefecture_id"),
        F.lit("source_prefecture_name_ko"), region["name_ko"],
        F.lit("source_url"), region["source_url"],
        F.lit("inheritance_note"), note,
    )
    inherits = ~collected(F.col("climate_table"), F.col("field_status")) & region.isNotNull()
    kept = F.map_filter(region["climate_table"], lambda k, _: ~F.map_contains_key(origin, k))
    status = F.map_concat(
        F.map_filter(
            F.coalesce("field_status", F.create_map().cast("map<string,string>")), lambda k, _: k != "climate_table"
        ),
        F.create_map(F.lit("climate_table"), F.lit(COLLECTED)),
    )
    return joined.withColumns(
        {
            "climate_table": F.when(inherits, F.map_concat(kept, origin)).otherwise(F.col("climate_table")),
            "field_status": F.when(inherits, status).otherwise(F.col("field_status")),
        }
    ).select(*cities.columns)
