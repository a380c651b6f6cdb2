"""Column allow-lists of the domain items."""

from __future__ import annotations

# Attributes each entity type may carry.
COMMON_COLUMNS = (
    "PK", "SK", "entity_id", "entity_type", "content_id", "contenttypeid", "city_id",
    "city_name_en", "city_name_ko", "province", "province_key", "city_key", "domain_sort_key",
    "title", "address", "longitude", "latitude", "image_url", "description", "homepage",
    "zipcode", "copyright_type", "created_time", "modified_time", "quality_status",
    "review_queues", "source_key", "lcls_systm3", "source_type", "raw_s3_uri",
)
CITY_COLUMNS = (
    "PK", "SK", "entity_id", "entity_type", "city_id", "city_name_en", "city_name_ko",
    "province", "province_key", "city_key", "domain_sort_key", "sigungus_included",
    "scraped_at", "quality_status", "review_queues", "source_key",
)
STATISTIC_MEASURES = (
    "locals_total", "locals_daily_avg", "out_of_town_total", "out_of_town_daily_avg",
    "foreigners_total", "foreigners_daily_avg", "total_visitors", "total_daily_avg",
)
STATISTIC_COLUMNS = (
    "PK", "SK", "entity_id", "entity_type", "city_id", "city_name_en", "city_name_ko",
    "province", "province_key", "city_key", "domain_sort_key", "year", "month", "days",
    *STATISTIC_MEASURES, "annual_totals", "annual_daily_averages", "quality_status",
    "review_queues", "source_key",
)
ATTRACTION_COLUMNS = (
    *COMMON_COLUMNS, "theme", "theme_tags", "phone", "opening_hours", "closed_days",
    "experience_guide", "parking", "season_tags", "attraction_subtype_code",
    "attraction_subtype_name", "classification_source", "classification_mapping_version",
)
FESTIVAL_COLUMNS = (
    *COMMON_COLUMNS, "event_start_date", "event_end_date", "month", "season", "season_tags",
    "visit_months", "venue", "organizer", "organizer_phone", "playtime", "fee_text",
    "source_subtype_name", "source_theme", "program", "subevent", "theme", "theme_tags", "gsi_sk",
)
ENTITY_COLUMNS = {
    "attraction": ATTRACTION_COLUMNS,
    "festival": FESTIVAL_COLUMNS,
    "city_metadata": CITY_COLUMNS,
    "visitor_statistics": STATISTIC_COLUMNS,
}
BUCKETS = (
    "city_metadata", "visitor_statistics", "attractions", "festivals", "review", "failed", "load_items",
)
