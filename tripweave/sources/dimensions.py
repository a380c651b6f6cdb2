"""Dimension tables and lookup loaders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.text import blank_to_null, strip
from tripweave.sources import fixed

# Exclusion sets and targets of the theme mapping.
TARGET_THEMES = ("온천·휴양", "바다·해안", "역사·전통", "미식·노포", "자연·트레킹", "예술·감성")
TARGET_REGION_CODES = ("51", "47")
EXCLUDED_LARGE = ("체험관광",)
EXCLUDED_MIDDLE = ("기타문화관광지", "레저스포츠시설", "교육시설", "공연시설", "복합관광시설")
EXCLUDED_NAMES = (
    "기타주점", "클럽", "기타간이음식", "북한관광지", "기타안보관광지", "기타 종교성지", "약수터",
)

PROVINCE_SCHEMA = "province_id string, name_ko string, name_en string, region string"
PREFECTURE_SCHEMA = "prefecture_id string, name_ko string, name_ja string, name_en string, region string"
CLASSIFICATION_SCHEMA = "code string, name string, type string, theme string"


def provinces(spark: SparkSession) -> DataFrame:
    """The 17 Korean provinces."""
    return spark.createDataFrame(fixed.PROVINCES, PROVINCE_SCHEMA)


def prefectures(spark: SparkSession) -> DataFrame:
    """The 47 Japanese prefectures."""
    return spark.createDataFrame(fixed.PREFECTURES, PREFECTURE_SCHEMA)


def province_regions() -> list[tuple[str, Sequence[str], str]]:
    """Provinces in the form ``detect_region`` expects."""
    return [(i, [ko], en.replace("-do", "")) for i, ko, en, _ in fixed.PROVINCES]


def prefecture_regions() -> list[tuple[str, Sequence[str], str]]:
    """Prefectures in the form ``detect_region`` expects."""
    return [(i, [ko, ja], en) for i, ko, ja, en, _ in fixed.PREFECTURES]


def tokyo_korean_name(title: Column) -> Column:
    """Korean name of a Tokyo municipality title, '' when unknown."""
    names = F.create_map(*[F.lit(x) for pair in fixed.TOKYO_MUNICIPALITIES for x in pair])
    return F.coalesce(F.try_element_at(names, title), F.lit(""))


def classification(spark: SparkSession) -> DataFrame:
    """Built-in classification table; its size is fixed, so it is broadcast."""
    return F.broadcast(spark.createDataFrame(fixed.CLASSIFICATION, CLASSIFICATION_SCHEMA))


def last_per_code(rows: DataFrame, code: str, order: str) -> DataFrame:
    """One row per code, the last one given wins."""
    others = [c for c in rows.columns if c not in (code, order)]
    return (
        rows.groupBy(code)
        .agg(F.max_by(F.struct(*others), F.col(order)).alias("kept"))
        .select(code, *[F.col(f"kept.{c}").alias(c) for c in others])
    )


def read_classification(spark: SparkSession, path: str) -> DataFrame:
    """Classification rows of ``{"version":…, "mappings":{code:{…}}}`` files."""
    body = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    return body.select(
        F.try_variant_get("v", "$.version", "string").alias("version"),
        F.explode(F.try_variant_get("v", "$.mappings", "map<string,variant>")).alias("key", "e"),
    ).select(
        F.col("key").alias("code"),
        *[F.try_variant_get("e", f"$.{n}", "string").alias(n) for n in ("name", "type", "theme")],
        "version",
    )


def theme_map(
    mapping: DataFrame,
    excluded_themes: Iterable[str] = (),
    target_themes: Sequence[str] = TARGET_THEMES,
) -> DataFrame:
    """code → theme from mapping rows
    (theme, code, name, large_category, middle_category, ordinal).

    Rows of other themes or of an excluded category or name are dropped; a
    code listed twice keeps its last theme.
    """
    empty = F.lit("")
    excluded = (
        F.coalesce(F.col("large_category"), empty).isin(*EXCLUDED_LARGE)
        | F.coalesce(F.col("middle_category"), empty).isin(*EXCLUDED_MIDDLE)
        | F.coalesce(F.col("name"), empty).isin(*EXCLUDED_NAMES)
    )
    wanted = [t for t in target_themes if t not in set(excluded_themes)]
    kept = mapping.where(F.col("theme").isin(*wanted) & ~excluded & (F.col("code") != ""))
    return last_per_code(kept.select("code", "theme", "ordinal"), "code", "ordinal")


def read_theme_map(spark: SparkSession, path: str, excluded_themes: Iterable[str] = ()) -> DataFrame:
    """``theme_map`` of a ``{theme: [record, …]}`` JSON file."""
    body = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    themes = body.select(F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("theme", "l"))
    rows = themes.select("theme", F.posexplode(F.try_variant_get("l", "$", "array<variant>")).alias("p", "r"))
    fields = ("code", "name", "large_category", "middle_category")
    return theme_map(
        rows.select(
            "theme",
            *[F.try_variant_get("r", f"$.{n}", "string").alias(n) for n in fields],
            F.struct("theme", "p").alias("ordinal"),
        ),
        excluded_themes,
    )


def city_name_lookup(cities: DataFrame) -> DataFrame:
    """Korean → English city name; blanks are dropped, the last one wins.

    ``cities`` has city_name_ko, city_name_en and ``ordinal``.
    """
    named = cities.where((F.col("city_name_ko") != "") & (F.col("city_name_en") != ""))
    return last_per_code(
        named.select("city_name_ko", "city_name_en", "ordinal"), "city_name_ko", "ordinal"
    )


def sigungu_codes(raw: DataFrame) -> DataFrame:
    """Valid district codes: numeric code and both names present."""
    return raw.where(
        F.col("code").rlike(r"\A\d+\z")
        & (F.coalesce("city_name_ko", F.lit("")) != "")
        & (F.coalesce("city_name_en", F.lit("")) != "")
    ).select("code", "city_name_ko", "city_name_en", "province_id")


def read_sigungu_codes(spark: SparkSession, path: str) -> DataFrame:
    """District codes of a ``{code: {city_name_ko, …}}`` JSON file."""
    body = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    entries = body.select(F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("code", "e"))
    fields = ("city_name_ko", "city_name_en", "province_id")
    return sigungu_codes(
        entries.select("code", *[F.try_variant_get("e", f"$.{n}", "string").alias(n) for n in fields])
    )


def city_targets(
    cities: DataFrame,
    city_ids: Sequence[str] = (),
    city_names_en: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Targets with an id, optionally limited by id or English name (any case).

    Names may be a table with the column ``city_name_en``.
    """
    out = cities.select(
        strip(F.coalesce("city_id", F.lit(""))).alias("city_id"),
        strip(F.coalesce("city_name_ko", F.lit(""))).alias("city_name_ko"),
        strip(F.coalesce("city_name_en", F.lit(""))).alias("city_name_en"),
        F.nullif("prefecture_id", F.lit("")).alias("prefecture_id"),
    ).where(F.col("city_id") != "")
    if city_ids:
        out = out.where(F.upper("city_id").isin(*[i.upper() for i in city_ids]))
    if isinstance(city_names_en, DataFrame):
        names = city_names_en.select(F.lower("city_name_en").alias("_name")).distinct()
        return out.join(names, F.lower("city_name_en") == F.col("_name"), "left_semi")
    if city_names_en:
        out = out.where(F.lower("city_name_en").isin(*[n.lower() for n in city_names_en]))
    return out


def region_targets(
    districts: DataFrame,
    city_names_ko: Sequence[str] | DataFrame = (),
    region_codes: Sequence[str] = TARGET_REGION_CODES,
) -> DataFrame:
    """Districts of the covered regions, optionally limited by name.

    Names may be a table with the column ``city_name_ko``.  An empty selection
    is an error.
    """
    out = districts.where(F.col("lDongRegnCd").cast("string").isin(*region_codes))
    if isinstance(city_names_ko, DataFrame):
        names = city_names_ko.select(F.col("city_name_ko").alias("_name")).distinct()
        out = out.join(names, F.col("lDongSignguNm") == F.col("_name"), "left_semi")
    elif city_names_ko:
        out = out.where(F.col("lDongSignguNm").isin(*city_names_ko))
    if out.isEmpty():
        raise ValueError("no target district selected")
    return out


def coverage_gap(dimension: DataFrame, targets: DataFrame, name: str = "title") -> DataFrame:
    """Names of the dimension that no target mentions."""
    wanted = dimension.select(name).where(blank_to_null(F.col(name)).isNotNull()).distinct()
    return wanted.join(targets.select(name).distinct(), name, "left_anti")


def with_english_name(targets: DataFrame, lookup: DataFrame, ko: str = "city_name_ko") -> DataFrame:
    """English name from the lookup, else the Korean one with underscores."""
    names = lookup.select(F.col("city_name_ko").alias(ko), F.col("city_name_en").alias("_en"))
    return (
        targets.join(names, ko, "left")
        .withColumn("city_name_en", F.coalesce("_en", F.replace(F.col(ko), F.lit(" "), F.lit("_"))))
        .drop("_en")
    )
