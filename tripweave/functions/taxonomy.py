"""Fixed vocabularies and the checks of model answers against them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.text import strip

# Vocabularies a model answer may use.
VIBE_TAGS = (
    "romantic", "nostalgic", "cozy", "meditative", "refreshing", "inspiring",
    "calm", "peaceful", "healing", "relaxing", "serene", "artistic", "traditional", "rustic",
    "open_view", "panoramic_view", "ocean_view", "mountain_view", "river_view",
    "lake_view", "forest_view", "sunrise_view", "sunset_view", "night_view",
    "flower_view", "autumn_leaves", "snow_view",
    "local", "authentic", "regional_culture", "village_life", "craft",
    "old_restaurant", "local_market", "small_town", "rural", "retro", "community_based",
)
EXPERIENCE_TAGS = (
    "photo_spot", "picnic", "drive_course", "walking", "slow_travel",
    "cultural_experience", "nature_observation", "history_learning",
    "market_tour", "hands_on_experience",
)
COMPANION_FIT = ("family", "kids", "couple", "solo", "pet", "parents", "seniors")
INDOOR_OUTDOOR = ("indoor", "outdoor", "mixed", "unknown")
THEMES = ("바다·해안", "자연·트레킹", "미식·노포", "역사·전통", "예술·감성", "온천·휴양")
MAX_VIBE, MAX_EXPERIENCE, MAX_COMPANION, MAX_THEMES = 5, 3, 7, 3

_ATTRACTION_FIELDS = ("indoor_outdoor", "vibe_tags", "experience_tags", "companion_fit")


def _words(words: Sequence[str]) -> Column:
    return F.split(F.lit(",".join(words)), ",")


def response_text(text: Column) -> Column:
    """Model answer without a surrounding Markdown code fence."""
    clean = strip(text)
    fence = r"(?isU)\A```(?:json)?\s*(.*?)\s*```\z"
    return F.when(clean.rlike(fence), F.regexp_extract(clean, fence, 1)).otherwise(clean)


def parse_response(text: Column) -> Column:
    """VARIANT of an answer that is a JSON object, else null."""
    clean = response_text(text)
    return F.when(clean.rlike(r"(?U)\A\s*\{"), F.try_parse_json(clean))


def _string_list(response: Column, name: str) -> Column:
    raw = F.try_variant_get(response, f"$.{name}", "array<variant>")
    strings = F.transform(raw, lambda v: F.try_variant_get(v, "$", "string"))
    return F.coalesce(strings, F.array().cast("array<string>"))


def _allowed(response: Column, name: str, words: Sequence[str], limit: int) -> Column:
    known = _words(words)
    kept = F.filter(_string_list(response, name), lambda t: F.array_contains(known, t))
    return F.slice(kept, 1, limit)


def validate_attraction_tags(response: Column) -> Column:
    """Checked answer as a struct with ``valid`` and ``extra_fields``.

    An unknown field makes the answer invalid; unknown tags are dropped, lists
    are capped and an unknown place kind becomes ``unknown``.
    """
    keys = F.map_keys(F.try_variant_get(response, "$", "map<string,variant>"))
    extra = F.array_sort(F.array_except(keys, _words(_ATTRACTION_FIELDS)))
    place = F.try_variant_get(response, "$.indoor_outdoor", "string")
    return F.struct(
        F.coalesce(F.size(extra) == 0, F.lit(False)).alias("valid"),
        extra.alias("extra_fields"),
        F.when(place.isin(*INDOOR_OUTDOOR), place).otherwise(F.lit("unknown")).alias("indoor_outdoor"),
        _allowed(response, "vibe_tags", VIBE_TAGS, MAX_VIBE).alias("vibe_tags"),
        _allowed(response, "experience_tags", EXPERIENCE_TAGS, MAX_EXPERIENCE).alias("experience_tags"),
        _allowed(response, "companion_fit", COMPANION_FIT, MAX_COMPANION).alias("companion_fit"),
    )


def nothing_extracted(tags: Column) -> Column:
    """True when a checked attraction answer says nothing at all."""
    return (
        (tags["indoor_outdoor"] == "unknown")
        & (F.size(tags["vibe_tags"]) == 0)
        & (F.size(tags["experience_tags"]) == 0)
        & (F.size(tags["companion_fit"]) == 0)
    )


def validate_festival_themes(response: Column) -> Column:
    """``struct<valid,primary_theme,theme_tags>``; the primary theme is always
    among the at most three tags."""
    primary = F.try_variant_get(response, "$.primary_theme", "string")
    valid = F.coalesce(primary.isin(*THEMES), F.lit(False))
    tags = _allowed(response, "theme_tags", THEMES, MAX_THEMES)
    led = F.when(F.array_contains(tags, primary), tags).otherwise(
        F.slice(F.concat(F.array(primary), tags), 1, MAX_THEMES)
    )
    return F.struct(
        valid.alias("valid"),
        F.when(valid, primary).alias("primary_theme"),
        F.when(valid, led).otherwise(F.array().cast("array<string>")).alias("theme_tags"),
    )


MIN_TEXT_LENGTH = 30


def has_sufficient_text(*cols: Column) -> Column:
    """At least one text of thirty characters after stripping."""
    enough = F.lit(False)
    for col in cols:
        enough = enough | (F.coalesce(F.length(strip(col)), F.lit(0)) >= MIN_TEXT_LENGTH)
    return enough
