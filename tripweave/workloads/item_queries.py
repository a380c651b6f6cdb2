"""Keyed item, enrichment, vector and image queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.functions.calls import one_by_one
from tripweave.functions.hashing import attraction_input_hash, festival_input_hash
from tripweave.functions.names import romanize
from tripweave.functions.prompts import ATTRACTION_HEAD, ATTRACTION_TAIL, attraction_prompt, festival_prompt
from tripweave.functions.taxonomy import (
    has_sufficient_text,
    nothing_extracted,
    parse_response,
    validate_attraction_tags,
    validate_festival_themes,
)
from tripweave.operators import domain, enrich, images, keyvalue, vectors
from tripweave.plans.jobs import saved
from tripweave.sources import raw, sinks
from tripweave.workloads.registry import query

# --- keyed items ------------------------------------------------------------


def _items(t):
    items = t["items"]
    status = F.struct(F.col("classified").alias("status"))
    return items.withColumn("festival_theme_classification", status)


@query("SELECT PK, SK, title FROM {items} WHERE PK = 'CITY#NATION_3'")
def kv_city(t):
    """All items of a city."""
    return keyvalue.city_items(t["items"], "CITY#NATION_3").select("PK", "SK", "title")


@query("SELECT SK, title FROM {items} WHERE PK = 'CITY#NATION_6' AND SK LIKE 'ATTRACTION#%'")
def kv_prefix(t):
    """Items of a city with a sort-key prefix."""
    return keyvalue.city_items(t["items"], "CITY#NATION_6", "ATTRACTION#").select("SK", "title")


@query("SELECT PK, SK, title FROM {items} WHERE PK = 'CITY#NATION_8' AND SK = 'FESTIVAL#8'")
def kv_point(t):
    """Point lookup."""
    return keyvalue.get_item(t["items"], "CITY#NATION_8", "FESTIVAL#8").select("PK", "SK", "title")


@query("SELECT SK FROM {items} WHERE PK = 'CITY#NATION_8' AND SK BETWEEN 'ATTRACTION#1' AND 'ATTRACTION#6'")
def kv_range(t):
    """Sort-key range of a city."""
    return keyvalue.city_items_between(t["items"], "CITY#NATION_8", "ATTRACTION#1", "ATTRACTION#6").select("SK")


@query("SELECT domain_sort_key FROM {items} WHERE city_key = 'CITY#NATION_2' AND domain_sort_key LIKE 'FESTIVAL#%'")
def kv_city_index(t):
    """City index with a domain prefix."""
    return keyvalue.city_domain_items(t["items"], "CITY#NATION_2", "FESTIVAL#").select("domain_sort_key")


@query("SELECT PK, domain_sort_key FROM {items} WHERE province_key = 'PROVINCE#ASIA' AND domain_sort_key LIKE 'FESTIVAL#%'")
def kv_province(t):
    """Province index with a domain prefix."""
    return keyvalue.province_items(t["items"], "PROVINCE#ASIA", "FESTIVAL#").select("PK", "domain_sort_key")


@query("SELECT PK, SK FROM {items} WHERE entity_type = 'festival'")
def kv_entity(t):
    """Entity-type index scan."""
    return keyvalue.entity_items(t["items"], "festival").select("PK", "SK")


@query("SELECT gsi_sk FROM {items} WHERE entity_type = 'festival' AND substr(gsi_sk, 10, 2) = '10' AND classified = 'succeeded'")
def festival_month(t):
    """Classified festivals of October."""
    return keyvalue.festivals_in_month(_items(t), 10).select("gsi_sk")


@query("SELECT gsi_sk FROM {items} WHERE entity_type = 'festival' AND substr(gsi_sk, 10, 2) = '00'")
def festival_undated(t):
    """Undated festivals, whatever their classification."""
    return keyvalue.festivals_in_month(_items(t), 0, None).select("gsi_sk")


@query("SELECT entity_type, province_key, count(*) AS item_count FROM {items} GROUP BY 1, 2")
def kv_counts(t):
    """Count-only queries."""
    return keyvalue.count_items(t["items"], "entity_type", "province_key")


@query("""
    SELECT PK, SK, CASE WHEN u IS NULL THEN title ELSE concat('new ', cast(u AS string)) END AS title, CASE WHEN u IS NULL THEN theme END AS theme
    FROM {items} FULL JOIN (SELECT concat('CITY#NATION_', cast(o_custkey % 25 AS string)) AS PK, concat('ATTRACTION#', cast(o_custkey AS string)) AS SK,
      max(o_orderkey) AS u FROM {orders} GROUP BY 1, 2) n USING (PK, SK)""")
def kv_upsert(t):
    """Order-sized batch of writes over the items; the last write wins."""
    incoming = t.sql(
        "SELECT concat('CITY#NATION_', cast(o_custkey % 25 AS string)) AS PK, concat('ATTRACTION#', cast(o_custkey AS string)) AS SK, "
        "concat('new ', cast(o_orderkey AS string)) AS title, o_orderkey FROM {orders}"
    )
    existing = t["items"].select("PK", "SK", "title", "theme")
    return keyvalue.upsert(existing, incoming, ["o_orderkey"])


@query("""
    SELECT province_key, count(*) AS item_count FROM {items} WHERE province_key IS NOT NULL AND province_key NOT IN ('PROVINCE#ASIA', 'PROVINCE#EUROPE') GROUP BY 1""")
def kv_cleanup(t):
    """Report of the items outside the kept provinces."""
    _, removed = keyvalue.split_by_province(t["items"], ["PROVINCE#ASIA", "PROVINCE#EUROPE"])
    return keyvalue.removal_report(removed)


@query("SELECT coalesce(province_key, '(NO_ATTR)') AS province_key, count(*) AS item_count FROM {items} GROUP BY 1")
def kv_profile(t):
    """Items per province, missing ones included."""
    return keyvalue.province_profile(t["items"])


@query("SELECT PK, SK, city_key, province, city_name_ko, entity_type FROM {items} WHERE province_key IS NULL ORDER BY PK, SK LIMIT 3")
def kv_samples(t):
    """Three sample items without a province."""
    return keyvalue.without_province(t["items"])


@query("""
    SELECT pos, CASE WHEN pos % 2 = 0 THEN domain_sort_key ELSE concat(entity_type, '#', content_id) END AS domain_sort_key,
      CASE WHEN pos % 2 = 0 THEN gsi_sk WHEN entity_type = 'festival' THEN concat('FESTIVAL#', CASE WHEN event_start_date = '' THEN '00' ELSE substr(event_start_date, 5, 2) END, '#', content_id)
        ELSE concat(entity_type, '#', content_id) END AS gsi_sk,
      CASE WHEN pos % 2 = 0 THEN province_key ELSE coalesce(province_key, CASE WHEN province = '' THEN 'UNKNOWN' ELSE province END) END AS province_key
    FROM {items}""")
def key_backfill(t):
    """Index keys added to rows without them."""
    stripped = t["items"].withColumns(
        {
            "domain_sort_key": F.when(F.col("pos") % 2 == 0, F.col("domain_sort_key")),
            "month": F.lit(None).cast("string"),
            "entity_id": F.lit(""),
            "eventstartdate": F.regexp_replace("event_start_date", r"^(\d{4})(\d{2})", "$1-$2-"),
        }
    )
    return keyvalue.backfill_index_keys(stripped).select("pos", "domain_sort_key", "gsi_sk", "province_key")


@query("""
    SELECT count(CASE WHEN contentid <> '' THEN 1 END) AS loaded, count(CASE WHEN contentid = '' THEN 1 END) AS load_failed, 207 AS status_code FROM {content}""")
def load_summary(t):
    """Loaded and rejected rows; rows without a key are rejected."""
    rows = t["content"].select(F.lit("CITY#x").alias("PK"), F.col("contentid").alias("SK"))
    return keyvalue.load_summary(rows)


@query("SELECT pos FROM {items} WHERE province_key = 'PROVINCE#AFRICA'")
def province_filter(t):
    """Items of exactly one province."""
    return keyvalue.in_province(t["items"], "PROVINCE#AFRICA").select("pos")


@query("SELECT pos FROM {items} WHERE province LIKE '%AMERICA%' OR province_key LIKE '%ASIA%' OR province LIKE '%ASIA%'")
def provinces_filter(t):
    """Items mentioning one of some provinces."""
    return keyvalue.in_provinces(t["items"], ["AMERICA", "ASIA"]).select("pos")


@query("""
    SELECT pos, concat('CITY#', city_name_en) AS PK, concat(CASE WHEN contenttypeid = '15' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END, contentid) AS SK,
      concat(CASE WHEN contenttypeid = '15' THEN 'festival' ELSE 'attraction' END, '#', contentid) AS domain_sort_key,
      CASE WHEN contenttypeid = '15' THEN concat('FESTIVAL#', CASE WHEN start_ymd = '' THEN '00' ELSE substr(start_ymd, 5, 2) END, '#', contentid)
        ELSE concat('attraction#', contentid) END AS gsi_sk, title
    FROM {content} WHERE contentid <> ''""")
def legacy_load(t):
    """Processed documents normalised for the first table."""
    from tripweave.operators import legacy

    kind = F.when(F.col("contenttypeid") == "15", F.lit("festival")).otherwise(F.lit("attraction"))
    iso = F.regexp_replace("start_ymd", r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    record = F.struct(
        kind.alias("entity_type"),
        F.concat(F.when(kind == "festival", "FEST-").otherwise("ATT-"), "contentid").alias("entity_id"),
        F.col("contentid").alias("content_id"), "title", iso.alias("eventstartdate"),
    )
    # One document per record, so that its position is its key.
    docs = t["content"].where("contentid <> ''").select(
        F.col("pos").cast("string").alias("source_key"),
        F.to_json(
            F.struct(F.lit("passed").alias("status"), F.struct("city_name_en").alias("city_record"), F.array(record).alias("records"))
        ).alias("value"),
    )
    return legacy.load_rows(docs).select(
        F.col("source_key").cast("long").alias("pos"), "PK", "SK", "domain_sort_key", "gsi_sk", "title"
    )


def _stored_festivals(t):
    """Raw payloads loaded into the keyed items, duplicates resolved."""
    items = domain.domain_items(raw.parse_payloads(t.payloads), t["classes"])
    # Only the attributes of the month index travel through the upsert.
    load = domain.bucket_view(items, "load_items").select(
        "PK", "SK", "entity_type", "gsi_sk", "title", "source_key", "position"
    )
    # The key tells a festival, so nothing else reaches the pick.
    festivals = load.where(keyvalue.has_key() & F.startswith("SK", F.lit("FESTIVAL#")))
    return keyvalue.pick_per_key(festivals, keyvalue.KEYS, F.struct("source_key", "position"))


@query("""
    SELECT concat('CITY#', city_name_en) AS PK, concat('FESTIVAL#10#', contentid) AS gsi_sk, title FROM {content}
    WHERE contenttypeid = '15' AND contentid <> '' AND title <> '' AND substr(start_ymd, 5, 2) = '10'""")
def festivals_of_october(t):
    """From raw payloads over domain items and upsert to a month query."""
    return keyvalue.festivals_in_month(_stored_festivals(t), 10, None).select("PK", "gsi_sk", "title")


# --- hashes and enrichment --------------------------------------------------

DOCS = """
    SELECT doc_id, lang AS theme, source AS address, concat(source, ' ', lang, ' ', cast(n_chars AS string)) AS title, text AS description, 'attraction' AS entity_type,
      cast(doc_id AS string) AS content_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS program, '' AS subevent FROM {documents}
"""


@query(f"""
    SELECT doc_id, concat('sha256:', sha256(lower(concat(regexp_replace(address, '\\s+', '', 'g'), regexp_replace(description, '\\s+', '', 'g'),
      theme, concat('["', theme, '","', replace(address, ' ', ''), '"]'), regexp_replace(title, '\\s+', '', 'g'))))) AS input_hash FROM ({DOCS}) d""")
def input_hash_attraction(t):
    """Change signature of attraction fields."""
    items = t.sql(DOCS).withColumn("theme_tags", F.array("theme", "address"))
    return items.select("doc_id", attraction_input_hash(items.schema).alias("input_hash"))


@query(f"""
    SELECT doc_id, concat('sha256:', sha256(lower(replace(concat(content_id, description, entity_type, coalesce(program, ''), subevent, title), ' ', '')))) AS input_hash
    FROM ({DOCS}) d""")
def input_hash_festival(t):
    """Change signature of festival fields."""
    items = t.sql(DOCS)
    return items.select("doc_id", festival_input_hash(items.schema).alias("input_hash"))


@query(f"""
    SELECT d.doc_id, coalesce(l.quality = 1 AND d.doc_id % 4 <> 0 AND l.toxic = 0, false) AS unchanged FROM ({DOCS}) d LEFT JOIN {{labels}} l ON l.doc_id = d.doc_id""")
def skip_unchanged(t):
    """Items whose earlier result is still valid."""
    items = t.sql(DOCS)
    items = items.withColumn("hash", festival_input_hash(items.schema))
    history = t["labels"].join(items.select("doc_id", "hash"), "doc_id").select(
        "doc_id",
        F.when(F.col("quality") == 1, "succeeded").otherwise("failed").alias("status"),
        F.when(F.col("doc_id") % 4 != 0, F.col("hash")).otherwise("sha256:old").alias("input_hash"),
        F.when(F.col("toxic") == 0, "v1").otherwise("v0").alias("prompt_version"),
        F.lit("m").alias("model_id"),
    )
    joined = enrich.with_history(items, history, "doc_id", "history")
    return joined.select("doc_id", enrich.is_unchanged(F.col("history"), F.col("hash"), "v1", "m").alias("unchanged"))


@query("SELECT pos FROM {items} WHERE coalesce(nullif(updated_at, ''), collected_at) > '2026-04-01T00:00:00Z'")
def incremental_since(t):
    """Items modified after a time stamp."""
    return vectors.modified_since(t["items"], "2026-04-01T00:00:00Z").select("pos")


ANSWERS = """
    SELECT doc_id, concat(CASE WHEN doc_id % 6 = 0 THEN '```json ' WHEN doc_id % 6 = 1 THEN ' ' ELSE '' END,
      CASE WHEN doc_id % 10 = 9 THEN 'no json' WHEN doc_id % 10 = 8 THEN '[1]' ELSE concat('{"indoor_outdoor": "', CASE doc_id % 4 WHEN 0 THEN 'indoor' WHEN 1 THEN 'sky' ELSE 'unknown' END,
        '", "vibe_tags": [', CASE WHEN doc_id % 3 = 0 THEN '"cozy", "bad", 5, "retro", "calm", "cozy", "local", "rural"' ELSE '' END,
        '], "experience_tags": ["', CASE WHEN doc_id % 5 = 0 THEN 'picnic' ELSE lang END, '"]', CASE WHEN doc_id % 7 = 0 THEN ', "extra": 1' ELSE '' END, '}') END,
      CASE WHEN doc_id % 6 = 0 THEN ' ```' ELSE '' END) AS answer FROM {documents}
"""


@query(f"""
    SELECT doc_id, doc_id % 10 < 8 AS parsed, CASE WHEN doc_id % 10 < 8 THEN doc_id % 7 <> 0 ELSE false END AS valid,
      CASE WHEN doc_id % 10 < 8 AND doc_id % 4 = 0 THEN 'indoor' ELSE 'unknown' END AS place,
      CASE WHEN doc_id % 10 < 8 AND doc_id % 3 = 0 THEN 'cozy,retro,calm,cozy,local' ELSE '' END AS vibe,
      CASE WHEN doc_id % 10 < 8 AND doc_id % 5 = 0 THEN 'picnic' ELSE '' END AS experience,
      NOT (doc_id % 10 < 8 AND (doc_id % 4 = 0 OR doc_id % 3 = 0 OR doc_id % 5 = 0)) AS empty
    FROM ({ANSWERS.replace('{"', '[["').replace("'}')", "']]')")}) a""")
def taxonomy_validate(t):
    """Model answers reduced to the fixed vocabularies."""
    answers = t["documents"].selectExpr("doc_id", ANSWERS.split("doc_id, ", 1)[1].split(" AS answer")[0] + " AS answer")
    parsed = answers.withColumn("v", parse_response(F.col("answer"))).withColumn("c", validate_attraction_tags(F.col("v")))
    c = F.col("c")
    return parsed.select(
        "doc_id", F.col("v").isNotNull().alias("parsed"), c["valid"].alias("valid"), c["indoor_outdoor"].alias("place"),
        F.array_join(c["vibe_tags"], ",").alias("vibe"), F.array_join(c["experience_tags"], ",").alias("experience"),
        nothing_extracted(c).alias("empty"),
    )


@query("""
    SELECT doc_id, doc_id % 4 <> 3 AS valid, CASE doc_id % 4 WHEN 0 THEN '바다·해안' WHEN 1 THEN '역사·전통' WHEN 2 THEN '온천·휴양' END AS primary_theme,
      CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 3 = 0 THEN '바다·해안,미식·노포' ELSE '바다·해안' END
        WHEN 1 THEN CASE WHEN doc_id % 3 = 0 THEN '역사·전통,미식·노포' ELSE '역사·전통' END
        WHEN 2 THEN CASE WHEN doc_id % 3 = 0 THEN '온천·휴양,미식·노포' ELSE '온천·휴양' END ELSE '' END AS theme_tags FROM {documents}""")
def theme_validate(t):
    """Theme answers reduced to the six themes, the primary one first."""
    answer = F.concat(
        F.lit('{"primary_theme": "'),
        F.expr("CASE doc_id % 4 WHEN 0 THEN '바다·해안' WHEN 1 THEN '역사·전통' WHEN 2 THEN '온천·휴양' ELSE '기타' END"),
        F.lit('", "theme_tags": ["x"'),
        F.expr("CASE WHEN doc_id % 3 = 0 THEN ', \"미식·노포\"' ELSE '' END"),
        F.lit("]}"),
    )
    checked = t["documents"].select("doc_id", validate_festival_themes(parse_response(answer)).alias("c"))
    return checked.select(
        "doc_id", "c.valid", "c.primary_theme", F.array_join("c.theme_tags", ",").alias("theme_tags")
    )


@query("""
    SELECT doc_id, length(trim(CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN concat(source, ' ', lang, repeat(' x', cast(n_chars % 20 AS int))) ELSE lang END,
      chr(10) || ' ')) >= 30 AS enough FROM {documents}""")
def text_sufficient(t):
    """Documents with enough text to classify."""
    text = F.expr("CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN concat(source, ' ', lang, repeat(' x', cast(n_chars % 20 AS int))) ELSE lang END")
    return t["documents"].select("doc_id", has_sufficient_text(text, F.lit("short")).alias("enough"))


_ROOM = 12_000 - len(ATTRACTION_HEAD) - len(ATTRACTION_TAIL)


@query(f"""
    WITH d AS ({DOCS}), lines AS (SELECT *, concat('entity_type: attraction', chr(10), 'content_id: ', content_id, chr(10), 'title: ', title, chr(10)) AS head,
        concat(CASE WHEN theme <> '' THEN concat(chr(10), 'theme: ', theme) ELSE '' END, chr(10), 'address: ', address) AS tail FROM d)
    SELECT doc_id, length(info) + {12_000 - _ROOM} AS prompt_chars, md5(info) AS info_hash FROM (SELECT doc_id, concat(head,
      CASE WHEN description = '' THEN '' ELSE concat('description: ', substr(description, 1, greatest(0, {_ROOM} - length(head) - length(tail) - length('description: ')))) END, tail) AS info FROM lines) x""")
def prompt_build(t):
    """Attraction prompts within 12,000 characters."""
    items = t.sql(DOCS)
    prompt = attraction_prompt(items.schema)
    built = items.select("doc_id", prompt.alias("p")).withColumn("n", F.length("p").cast("long"))
    info = F.substring("p", F.lit(len(ATTRACTION_HEAD) + 1), F.col("n").cast("int") - (12_000 - _ROOM))
    return built.select("doc_id", F.col("n").alias("prompt_chars"), F.md5(info).alias("info_hash"))


@query(f"""
    SELECT doc_id, length(concat('entity_type: attraction', chr(10), 'content_id: ', content_id, chr(10), 'title: ', title, chr(10), 'description: ', description,
      coalesce(chr(10) || 'program: ' || program, ''))) AS info_chars FROM ({DOCS}) d""")
def festival_prompt_build(t):
    """Festival prompts without blank fields."""
    items = t.sql(DOCS)
    empty = len(festival_prompt_text_around())
    return items.select("doc_id", (F.length(festival_prompt(items.schema)) - empty).cast("long").alias("info_chars"))


def festival_prompt_text_around() -> str:
    from tripweave.functions.prompts import FESTIVAL_HEAD, FESTIVAL_TAIL, THEME_SET_LABEL

    return (FESTIVAL_HEAD + FESTIVAL_TAIL).replace("{label}", THEME_SET_LABEL)


_FESTIVAL_AROUND = len(festival_prompt_text_around())


def _documents(t):
    """Documents as items."""
    return t.sql(DOCS)


def _rule_model(prompt: str) -> str:
    """Stand-in model: tags by the length of the prompt."""
    if len(prompt) % 7 == 0:
        raise RuntimeError("model is down")
    if len(prompt) % 5 == 0:
        return "no json"
    return '{"indoor_outdoor": "%s", "vibe_tags": ["calm", "other"]}' % ("indoor" if len(prompt) % 2 else "mixed")


PROMPT_CHARS = f"""
    WITH d AS ({DOCS}), lines AS (SELECT *, concat('entity_type: attraction', chr(10), 'content_id: ', content_id, chr(10), 'title: ', title, chr(10)) AS head,
        concat(CASE WHEN theme <> '' THEN concat(chr(10), 'theme: ', theme) ELSE '' END, chr(10), 'address: ', address) AS tail FROM d),
    prompts AS (SELECT doc_id, {12_000 - _ROOM} + length(concat(head, CASE WHEN description = '' THEN '' ELSE concat('description: ',
      substr(description, 1, greatest(0, {_ROOM} - length(head) - length(tail) - length('description: ')))) END, tail)) AS n FROM lines)"""


@query(PROMPT_CHARS + """
    SELECT CASE WHEN ok THEN 'succeeded' ELSE 'failed' END AS status, CASE WHEN ok THEN CASE WHEN n % 2 = 1 THEN 'indoor' ELSE 'mixed' END END AS indoor_outdoor,
      CASE WHEN NOT ok THEN 'validation_error' END AS error_code, count(*) AS item_count
    FROM (SELECT n, n % 7 <> 0 AND n % 5 <> 0 AS ok FROM prompts) p GROUP BY ALL""")
def enrich_batch(t):
    """Attraction enrichment around a stand-in model."""
    results = enrich.enrich_attractions(_documents(t), one_by_one(_once(_rule_model)))
    return results.groupBy("result.status", "result.indoor_outdoor", "result.error_code").agg(F.count("*").alias("item_count"))


def _once(model):
    """Turns model failures into errors that are not retried."""

    def call(prompt: str) -> str:
        try:
            return model(prompt)
        except RuntimeError as exc:
            raise ValueError(str(exc)) from exc

    return call


@query(f"""
    SELECT status, count(*) AS item_count FROM (SELECT CASE WHEN doc_id % 9 = 0 THEN 'failed'
      WHEN greatest(length(trim(description, chr(10) || ' ')), length(coalesce(program, ''))) < 30 THEN 'review_required'
      WHEN (length(concat('entity_type: festival', chr(10), 'content_id: ', content_id, chr(10), 'title: ', title, chr(10), 'description: ', description,
        coalesce(chr(10) || 'program: ' || program, ''))) + {_FESTIVAL_AROUND}) % 2 = 1 THEN 'succeeded' ELSE 'failed' END AS status FROM ({DOCS}) d) s GROUP BY 1""")
def classify_batch(t):
    """Festival classification around a stand-in model."""

    def model(prompt: str) -> str:
        theme = "바다·해안" if len(prompt) % 2 else "기타"
        return '```json\n{"primary_theme": "%s", "theme_tags": []}\n```' % theme

    items = _documents(t).withColumn("entity_type", F.when(F.col("doc_id") % 9 == 0, "attraction").otherwise("festival"))
    return enrich.batch_counts(enrich.classify_festivals(items, one_by_one(model)))


# --- vectors ----------------------------------------------------------------

def _tagged(t):
    """Items with the tag columns a class-tag list is made of."""
    return t["items"].withColumns(
        {
            "class_tags": F.array(F.lit("walk"), F.col("theme")),
            "category_tags": F.when(F.col("pos") % 2 == 0, F.col("city_name_en")),
            "classification": F.struct(
                F.lit("scenery").alias("theme"), F.array(F.lit("walk"), F.lit("photo")).alias("tags")
            ),
            "theme_tags": F.when(F.col("pos") % 4 == 0, F.array(F.lit("own"))).otherwise(F.array().cast("array<string>")),
            "season_tags": F.array(F.lit("spring")),
            "visit_months": F.array(F.lit(4), F.lit(5)),
            "season": F.lit("spring"),
            "longitude": F.lit(128.5),
            "attraction_subtype_code": F.when(F.col("pos") % 3 == 0, F.lit("NA01")),
        }
    )


CLASS_TAGS = "concat_ws(',', 'walk', CASE WHEN theme <> '' THEN theme END, CASE WHEN pos % 2 = 0 THEN city_name_en END, 'scenery', 'photo')"
VECTOR_ROWS = "SELECT * FROM {items} WHERE coalesce(nullif(quality_status, ''), 'passed') = 'passed'"


@query(f"SELECT pos, {CLASS_TAGS} AS class_tags FROM {{items}}")
def class_tags(t):
    """Distinct class tags of items."""
    items = _tagged(t)
    return items.select("pos", F.array_join(vectors.class_tags(items.schema), ",").alias("class_tags"))


@query(f"SELECT pos FROM ({VECTOR_ROWS}) v")
def vectorizable(t):
    """Items that belong into the vector index."""
    return vectors.export_items(t["items"]).select("pos")


@query(f"""
    SELECT concat(entity_type, '#', content_id, '#0') AS key, concat(entity_type, '#', content_id) AS place_id,
      concat('이름: ', CASE WHEN title <> '' THEN title ELSE city_name_ko END, chr(10), '유형: ', CASE WHEN entity_type = 'festival' THEN '축제' ELSE '관광지' END, chr(10),
        '도시: ', city_name_ko, ' (', city_name_en, ')', chr(10), '지역: ', province, chr(10), CASE WHEN address <> '' THEN concat('주소: ', address, chr(10)) ELSE '' END,
        '분류: ', replace({CLASS_TAGS}, ',', ', '), chr(10),
        CASE WHEN entity_type = 'festival' THEN concat(
            CASE WHEN event_start_date <> '' OR event_end_date <> '' THEN concat('기간: ', trim(concat(event_start_date, '~', event_end_date), '~'), chr(10)) ELSE '' END, '계절: spring', chr(10))
          WHEN theme <> '' THEN concat('테마: ', theme, chr(10)) ELSE '' END, '설명: ', description) AS embedding_text,
      CASE WHEN entity_type = 'festival' AND classified = 'succeeded' AND pos % 4 = 0 THEN 'own'
        ELSE concat_ws(',', CASE WHEN pos % 4 = 0 THEN 'own' ELSE 'spring' END, CASE WHEN theme <> '' THEN theme END, 'walk',
          CASE WHEN pos % 2 = 0 THEN city_name_en END, 'scenery', 'photo') END AS theme_tags,
      CASE WHEN entity_type = 'attraction' AND pos % 3 = 0 THEN 'NA01' END AS subtype, latitude, PK AS ddb_pk
    FROM ({VECTOR_ROWS}) v""")
def chunk_build(t):
    """Embedding chunks with their filter metadata."""
    items = _tagged(t).withColumn("festival_theme_classification", F.struct(F.col("classified").alias("status")))
    chunks = vectors.build_chunks(vectors.export_items(items))
    return chunks.select(
        "key", "place_id", "embedding_text", F.array_join("metadata.theme_tags", ",").alias("theme_tags"),
        F.col("metadata.attraction_subtype_code").alias("subtype"), "metadata.latitude", "metadata.ddb_pk",
    )


_BARE = len('{"country":"KR","entity_type":"attraction","source_type":"attraction","source_id":"","place_id":"attraction#","title":""}') + len(
    ',"experience_tags":[],"vibe_tags":[]'
)


def _tag_sizes(separator: str) -> str:
    return f"""SELECT doc_id, sum(b + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) - 1 AS used FROM (
      SELECT doc_id, i, octet_length(encode(cast(to_json(x) AS varchar))) AS b FROM (
        SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS x FROM (SELECT doc_id, string_split(text, {separator}) AS l FROM documents) s) y) u"""


@query(f"""
    WITH d AS (SELECT doc_id, {_BARE} + 2 * length(cast(doc_id AS varchar)) + octet_length(encode(concat(source, ' ', lang))) AS base FROM documents),
    e AS ({_tag_sizes("' '")}), v AS ({_tag_sizes("chr(10)")}),
    c AS (SELECT doc_id, base, max(used) AS all_v, count(*) AS n_v, coalesce(max(CASE WHEN base + used <= 2048 THEN used END), 0) AS some_v,
      count(CASE WHEN base + used <= 2048 THEN 1 END) AS fit_v, base + max(used) <= 2048 AS whole FROM v JOIN d USING (doc_id) GROUP BY doc_id, base),
    x AS (SELECT c.doc_id, count(e.used) AS fit_e, coalesce(max(e.used), 0) AS some_e FROM c LEFT JOIN e ON e.doc_id = c.doc_id AND whole AND base + all_v + e.used <= 2048 GROUP BY 1)
    SELECT concat('attraction#', cast(doc_id AS varchar), '#0') AS key, CASE WHEN whole THEN fit_e ELSE 0 END AS experience, CASE WHEN whole THEN n_v ELSE fit_v END AS vibe,
      cast(base + CASE WHEN whole THEN all_v + some_e ELSE some_v END AS bigint) AS bytes, cast(NULL AS varchar) AS error
    FROM c JOIN x USING (doc_id)""")
def metadata_budget(t):
    """Tags dropped from oversized metadata."""
    items = t["documents"].select(
        F.lit("attraction").alias("entity_type"), F.col("doc_id").cast("string").alias("content_id"),
        F.concat_ws(" ", "source", "lang").alias("title"), F.lit("succeeded").alias("s"),
        F.split("text", " ").alias("experience_tags"), F.split("text", "\n").alias("vibe_tags"),
    ).withColumn("metadata_enrichment", F.struct(F.col("s").alias("status")))
    chunks = vectors.build_chunks(items)
    m = F.col("metadata")
    return chunks.select(
        "key", F.size(m["experience_tags"]).alias("experience"), F.size(m["vibe_tags"]).alias("vibe"),
        vectors.filter_bytes(m).alias("bytes"), "error",
    )


@query("""
    SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'metadata keys are not allowlisted: bogus'
      WHEN octet_length(encode(concat('{"title":"', repeat('x', cast(n_chars % 3000 AS int)), '"}'))) > 2048
        THEN concat('filterable metadata is ', cast(12 + n_chars % 3000 AS string), ' bytes, exceeds 2048') END AS error FROM {documents}""")
def metadata_check(t):
    """Allow-list and size check of metadata objects."""
    title = F.concat(F.lit('"title":"'), F.repeat(F.lit("x"), (F.col("n_chars") % 3000).cast("int")), F.lit('"'))
    extra = F.when(F.col("doc_id") % 5 == 0, F.lit(',"bogus":1')).otherwise(F.lit(',"raw_s3_uri":"r"'))
    return t["documents"].select("doc_id", vectors.metadata_error(F.concat(F.lit("{"), title, extra, F.lit("}"))).alias("error"))


@query("""
    SELECT key, min(l_orderkey * 10 + l_linenumber) AS pos FROM (SELECT *, concat('place#', cast(l_partkey AS string)) AS key FROM {lineitem}) l GROUP BY 1""")
def vector_dedupe(t):
    """First record of every vector key."""
    records = t["lineitem"].select(
        F.concat(F.lit("place#"), "l_partkey").alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")
    )
    return vectors.first_per_key(records, "pos").select("key", "pos")


@query("""
    SELECT key, min(pos) AS pos FROM (SELECT concat('place#', cast(l_partkey AS string)) AS key, l_orderkey * 10 + l_linenumber AS pos FROM {lineitem}) l
    GROUP BY key, floor(pos / 500)""")
def vector_dedupe_batches(t):
    """First record of every key inside batches of 500 positions."""
    records = t["lineitem"].select(
        F.concat(F.lit("place#"), "l_partkey").alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")
    )
    return vectors.first_per_key(records, "pos", 500).select("key", "pos")


@query(f"SELECT entity_type, count(*) AS item_count FROM ({VECTOR_ROWS}) v GROUP BY 1")
def entity_counts(t):
    """Exported items per entity type."""
    return vectors.entity_counts(vectors.export_items(t["items"]))


# The query vector of the index smoke test.
SMOKE_VECTOR = [round(1.0 / 2 ** (i % 16 + 1), 8) for i in range(64)]
_DISTANCE = f"1 - list_cosine_similarity(cast(embedding AS double[]), {SMOKE_VECTOR}::double[])"


@query(f"SELECT vec_id, round({_DISTANCE}, 6) AS distance FROM {{embeddings}} ORDER BY {_DISTANCE}, vec_id LIMIT 10")
def vector_topk(t):
    """Ten nearest vectors by cosine distance, exact."""
    hits = vectors.cosine_top_k(t["embeddings"], SMOKE_VECTOR, 10, "vec_id")
    return hits.select("vec_id", F.round("distance", 6).alias("distance"))


@query(f"SELECT vec_id, round({_DISTANCE}, 6) AS distance FROM {{embeddings}} WHERE label = 3 ORDER BY {_DISTANCE}, vec_id LIMIT 5")
def vector_topk_filtered(t):
    """Nearest vectors among those with a metadata value."""
    rows = t["embeddings"].withColumn("metadata", F.struct("label"))
    hits = vectors.cosine_top_k(rows, SMOKE_VECTOR, 5, "vec_id", where=vectors.metadata_filter({"label": 3}))
    return hits.select("vec_id", F.round("distance", 6).alias("distance"))


@query("SELECT vec_id, label FROM {embeddings} WHERE vec_id IN (1, 7, 42)")
def vector_get(t):
    """Vectors by key."""
    return vectors.vectors_by_key(t["embeddings"], [1, 7, 42], "vec_id").select("vec_id", "label")


@query(f"""
    SELECT h.vec_id, i.title, round(h.d, 6) AS distance FROM (SELECT vec_id, {_DISTANCE} AS d FROM {{embeddings}} ORDER BY 2, 1 LIMIT 20) h
    JOIN {{items}} i ON i.PK = concat('CITY#NATION_', cast(h.vec_id % 25 AS string)) AND i.SK = concat('ATTRACTION#', cast(h.vec_id AS string))""")
def hit_lookup(t):
    """Items behind the best vector hits."""
    hits = vectors.cosine_top_k(t["embeddings"], SMOKE_VECTOR, 20, "vec_id")
    keyed = hits.withColumn(
        "metadata",
        F.struct(
            F.concat(F.lit("CITY#NATION_"), F.col("vec_id") % 25).alias("ddb_pk"),
            F.concat(F.lit("ATTRACTION#"), "vec_id").alias("ddb_sk"),
        ),
    )
    found = vectors.look_up_items(keyed, t["items"])
    return found.select(F.col("content_id").cast("long").alias("vec_id"), "title", F.round("distance", 6).alias("distance"))


@query("""
    SELECT count(*) AS items_processed, count(CASE WHEN ok THEN 1 END) AS items_upserted, count(CASE WHEN NOT ok THEN 1 END) AS items_skipped
    FROM (SELECT length(text) % 11 <> 0 AND length(text) % 13 <> 0 AS ok FROM {documents}) d""")
def embed_batch(t):
    """Embedding job around a stand-in function with failing rows."""
    rows = t["documents"].select(F.col("doc_id").alias("key"), F.col("text").alias("embedding_text"))

    def embed(text: str) -> list[float]:
        if len(text) % 11 == 0:
            raise RuntimeError("no embedding")
        return [float(len(text) % (i + 2)) for i in range(4 if len(text) % 13 else 3)]

    embedded = vectors.embed(rows, one_by_one(embed), dimension=4)
    return vectors.rebuild_summary(embedded)


@query("""
    SELECT count(*) AS chunk_count, count(CASE WHEN quality = 1 THEN 1 END) AS vector_success_count, count(CASE WHEN quality <> 1 THEN 1 END) AS failed_count FROM {labels}""")
def build_manifest(t):
    """Manifest of an index build with ready vectors."""
    chunks = t["labels"].select(F.col("doc_id").alias("key"), "quality")
    ready = chunks.where("quality = 1").select("key", F.array(F.lit(1.0)).alias("embedding"))
    embedded = vectors.attach_embeddings(chunks, ready)
    items = chunks.select(F.lit("attraction").alias("entity_type"))
    manifest = vectors.build_manifest(items, vectors.rebuild_summary(embedded), "index")
    return manifest.select("chunk_count", "vector_success_count", "failed_count")


# --- images -----------------------------------------------------------------


def _image_records(t):
    return t["content"].select(
        F.col("city_name_en").alias("city"),
        F.when(F.col("contenttypeid") == "15", 1).otherwise(0).alias("grp"),
        "pos", "contentid", "title", "firstimage", "firstimage2",
    )


TARGETS = """
    WITH bases AS (SELECT city_name_en AS city, CASE WHEN contenttypeid = '15' THEN 1 ELSE 0 END AS grp, pos, contentid, title, firstimage, trim(firstimage2) AS firstimage2,
        CASE WHEN title <> '' THEN array_to_string(list_transform(string_split(title, ' '), lambda w: concat(upper(w[1]), w[2:])), '')
          WHEN contentid <> '' THEN contentid ELSE 'item' END AS base FROM {content}),
    named AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY city, base ORDER BY grp, pos) = 1 THEN base ELSE concat(base, '_', contentid) END AS name FROM bases),
    targets AS (SELECT city, pos, name, '1' AS suffix, firstimage AS url FROM named WHERE firstimage <> ''
      UNION ALL SELECT city, pos, name, '2', firstimage2 FROM named WHERE firstimage2 <> ''),
    files AS (SELECT *, concat(name, '_', suffix, '.', lower(CASE WHEN url LIKE '%.jpg' THEN 'jpg' WHEN url LIKE '%.PNG%' THEN 'png' WHEN url LIKE '%.gif' THEN 'gif'
        ELSE 'jpg' END)) AS file_name FROM targets)
"""


@query(TARGETS + "SELECT city, pos, name, suffix, url FROM targets")
def image_targets(t):
    """Images to fetch with collision-free Latin names."""
    return images.image_targets(_image_records(t)).select("city", "pos", "name", "suffix", "url")


def _expected(t):
    return images.expected_files(images.image_targets(_image_records(t)))


def _stored(expected):
    """Stored files: all expected ones but every fifth record's."""
    return expected.where("pos % 5 <> 0").select(*images.IMAGE)


@query(TARGETS + "SELECT city, file_name, url FROM files WHERE pos % 5 = 0")
def image_missing(t):
    """Expected images that are not stored."""
    expected = saved(_expected(t), "images")
    return images.missing_files(expected, _stored(expected), images.IMAGE).select("city", "file_name", "url")


@query(TARGETS + """
    SELECT coalesce(city, 'TOTAL') AS city, count(*) AS expected, count(CASE WHEN pos % 5 <> 0 OR pos % 2 = 0 THEN 1 END) AS ok,
      count(CASE WHEN pos % 5 = 0 AND pos % 2 <> 0 THEN 1 END) AS failed, count(CASE WHEN pos % 5 = 0 AND pos % 2 = 0 THEN 1 END) AS recovered
    FROM files GROUP BY ROLLUP (city)""")
def image_audit(t):
    """Audit per city and in total, after a recovery attempt."""
    expected = saved(_expected(t), "images")
    missing = images.missing_files(expected, _stored(expected), images.IMAGE)
    outcomes = missing.select(*images.IMAGE, F.when(F.col("pos") % 2 != 0, "404").alias("error"))
    summary = images.audit_summary(expected, images.recovery(missing, outcomes, images.IMAGE))
    return summary.withColumn("city", F.coalesce("city", F.lit("TOTAL")))


def _processed(t):
    records = t["content"].select(
        "city_name_en", "pos", F.col("contentid").alias("content_id"), "title",
        F.lit("attraction").alias("entity_type"), F.lit("").alias("image_url"), "firstimage",
    )
    outcomes = t["content"].where("firstimage <> ''").select(
        "city_name_en", "pos", F.when(F.col("pos") % 11 == 0, "HTTP 404").alias("error")
    )
    return images.process_images(records, outcomes, "bucket")


PROCESSED = """
    WITH processed AS (SELECT city_name_en, contentid AS content_id, CASE WHEN firstimage = '' THEN 'no_source_image' WHEN pos % 11 = 0 THEN 'download_failed' END AS failure_reason,
        firstimage FROM {content})
"""


@query(PROCESSED + """
    SELECT city_name_en, content_id, firstimage AS original_image_url, failure_reason, CASE failure_reason WHEN 'download_failed' THEN 'HTTP 404' ELSE '' END AS error_message
    FROM processed WHERE failure_reason IS NOT NULL""")
def image_review(t):
    """Review rows of records without a stored image."""
    return images.image_review(_processed(t)).drop("timestamp", "entity_type")


@query(PROCESSED + """
    SELECT city_name_en, count(CASE WHEN failure_reason IS NULL THEN 1 END) AS images_ok, count(failure_reason) AS images_failed, count(*) AS records_loaded
    FROM processed GROUP BY 1""")
def image_cities(t):
    """Image report rows per city."""
    return images.city_image_rows(images.city_image_counts(_processed(t)))


@query(PROCESSED + """
    SELECT count(DISTINCT city_name_en) AS total_cities, count(CASE WHEN failure_reason IS NULL THEN 1 END) AS images_downloaded,
      count(CASE failure_reason WHEN 'download_failed' THEN 1 END) AS images_failed, count(failure_reason) AS review_count, count(*) AS records, 'partial' AS status FROM processed""")
def image_report(t):
    """Totals and status of an image run."""
    return images.image_report(images.city_image_counts(_processed(t))).drop("failure_info")


SYLLABLES = """
    SELECT p_partkey, cast(p_partkey * 7919 % 11172 AS int) AS a, cast(p_partkey * 104729 % 11172 AS int) AS b, cast(p_partkey * 31 % 11172 AS int) AS c FROM {part}
"""
_TABLES = """
    SELECT ['g','kk','n','d','tt','r','m','b','pp','s','ss','','j','jj','ch','k','t','p','h'] AS i,
      ['a','ae','ya','yae','eo','e','yeo','ye','o','wa','wae','oe','yo','u','wo','we','wi','yu','eu','ui','i'] AS v,
      ['','k','k','k','n','n','n','t','l','k','m','l','l','l','p','l','m','p','p','t','t','ng','t','t','k','t','p','t'] AS f
"""


def _spell(x: str, following: str | None) -> str:
    final = f"f[{x} % 28 + 1]"
    if following:
        final = f"CASE WHEN {x} % 28 = 8 AND {following} // 588 = 11 THEN 'r' ELSE {final} END"
    return f"i[{x} // 588 + 1], v[{x} % 588 // 28 + 1], {final}"


@query(f"""
    SELECT p_partkey, concat(upper(substr(w1, 1, 1)), substr(w1, 2), upper(substr(w2, 1, 1)), substr(w2, 2), 'Abc1') AS latin
    FROM (SELECT p_partkey, concat({_spell('a', 'b')}, {_spell('b', None)}) AS w1, concat({_spell('c', None)}) AS w2 FROM ({SYLLABLES}) s, ({_TABLES}) z) q""")
def romanized_names(t):
    """Latin spelling of Korean syllables."""

    def syllable(column: str):
        return F.decode(F.unhex(F.lpad(F.hex(F.col(column) + 44032), 4, "0")), "UTF-16BE")

    title = F.concat(syllable("a"), syllable("b"), F.lit(" "), syllable("c"), F.lit(" abc1(x)"))
    return t.sql(SYLLABLES).select("p_partkey", romanize(title).alias("latin"))


@query("SELECT pos, cast(cast(latitude AS decimal(10, 2)) AS string) AS latitude FROM {items}")
def decimal_items(t):
    """Doubles as exact decimals for a numeric store."""
    from pyspark.sql import types as T

    exact = sinks.decimal_view(t["items"].select("pos", "latitude"), T.DecimalType(10, 2))
    return exact.withColumn("latitude", F.col("latitude").cast("string"))
