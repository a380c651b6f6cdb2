"""Prompt texts handed to the injected model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.functions.hashing import column_types
from tripweave.functions.text import strip

# Prompt limits, fields and wording.
MAX_PROMPT_LENGTH = 12_000
ATTRACTION_FIELDS = (
    "entity_type", "content_id", "title", "description", "theme", "theme_tags",
    "experience_guide", "opening_hours", "closed_days", "parking", "address",
)
FESTIVAL_FIELDS = (
    "entity_type", "content_id", "title", "description", "program", "subevent",
    "venue", "playtime", "lcls_systm3", "source_theme",
)
ATTRACTION_HEAD = "다음 관광지 정보를 분석하여 메타데이터를 추출하세요.\n\n[관광지 정보]\n"
ATTRACTION_TAIL = """

[허용 태그 목록]
indoor_outdoor: indoor, outdoor, mixed, unknown

vibe_tags (최대 5개):
romantic, nostalgic, cozy, meditative, refreshing, inspiring, calm, peaceful, healing, relaxing, serene, artistic, traditional, rustic, open_view, panoramic_view, ocean_view, mountain_view, river_view, lake_view, forest_view, sunrise_view, sunset_view, night_view, flower_view, autumn_leaves, snow_view, local, authentic, regional_culture, village_life, craft, old_restaurant, local_market, small_town, rural, retro, community_based

experience_tags (최대 3개):
photo_spot, picnic, drive_course, walking, slow_travel, cultural_experience, nature_observation, history_learning, market_tour, hands_on_experience

companion_fit (최대 7개):
family, kids, couple, solo, pet, parents, seniors

[출력 형식] JSON으로 응답하세요:
{
  "indoor_outdoor": "indoor|outdoor|mixed|unknown",
  "vibe_tags": ["tag1", "tag2", ...],
  "experience_tags": ["tag1", ...],
  "companion_fit": ["type1", ...]
}"""
FESTIVAL_HEAD = "다음 축제 정보를 분석하여 {label}로 분류하세요.\n\n[축제 정보]\n"
FESTIVAL_TAIL = """

[{label}]
- 바다·해안
- 자연·트레킹
- 미식·노포
- 역사·전통
- 예술·감성
- 온천·휴양

[분류 규칙]
- primary_theme: 정확히 1개 선택
- theme_tags: 1~3개 선택 (primary_theme 포함)
- 부대 먹거리만으로 미식·노포 선택 금지
- 부대 공연만으로 예술·감성 선택 금지
- 바다 관련 장소/키워드 없이 물놀이만으로 바다·해안 선택 금지

[출력 형식] JSON:
{"primary_theme": "...", "theme_tags": ["...", "..."]}"""
THEME_SET_LABEL = "6대 테마"


def _field_text(types: dict[str, T.DataType], name: str) -> Column:
    if isinstance(types[name], T.ArrayType):
        return F.array_join(F.col(name).cast("array<string>"), ", ")
    return F.col(name).cast("string")


def _lines(parts: Sequence[tuple[str, Column]]) -> Column:
    """``name: text`` lines of the parts that have text."""
    rendered = [F.when(text != "", F.concat(F.lit(f"{name}: "), text)) for name, text in parts]
    return F.array_join(F.array_compact(F.array(*rendered)), "\n")


def attraction_prompt(schema: T.StructType) -> Column:
    """Prompt of at most 12,000 characters; a long description is cut first."""
    types = column_types(schema)
    parts = [(n, _field_text(types, n)) for n in ATTRACTION_FIELDS if n in types]

    def assemble(info: Column) -> Column:
        return F.concat(F.lit(ATTRACTION_HEAD), info, F.lit(ATTRACTION_TAIL))

    full = assemble(_lines(parts))
    prompt = full
    if "description" in types:
        description = _field_text(types, "description")
        without = _lines([p for p in parts if p[0] != "description"])
        room = MAX_PROMPT_LENGTH - F.length(assemble(without)) - 1 - len("description: ")
        cut = F.when(room > 0, F.substring(description, F.lit(1), room)).otherwise(F.lit(""))
        shortened = _lines([(n, cut if n == "description" else t) for n, t in parts])
        too_long = (F.length(full) > MAX_PROMPT_LENGTH) & (F.coalesce(description, F.lit("")) != "")
        prompt = F.when(too_long, assemble(shortened)).otherwise(full)
    return F.substring(prompt, 1, MAX_PROMPT_LENGTH)


def festival_prompt(schema: T.StructType, label: str = THEME_SET_LABEL) -> Column:
    """Classification prompt; white-space-only fields are left out.

    ``label`` is the name by which the prompt refers to the six themes.
    """
    types = column_types(schema)
    parts = []
    for name in FESTIVAL_FIELDS:
        if name in types:
            text = _field_text(types, name)
            parts.append((name, F.when(strip(text) != "", text)))
    head, tail = (part.replace("{label}", label) for part in (FESTIVAL_HEAD, FESTIVAL_TAIL))
    return F.concat(F.lit(head), _lines(parts), F.lit(tail))
