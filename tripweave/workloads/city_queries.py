"""Visitor statistics, city merge and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.functions.text import error_category
from tripweave.operators import merge, pages, quality, visitors
from tripweave.workloads.registry import query

# --- visitors ---------------------------------------------------------------


def _cents(value: str) -> str:
    # printf rounds the exact binary value, as the operator does.
    return f"cast(printf('%.2f', {value}) AS double)"


def _monthly_sql(feed: str) -> str:
    return f"""
    WITH sums AS (SELECT d.city_name_en, year(f.date) AS y, month(f.date) AS m,
        coalesce(sum(CASE WHEN f.tou_div_cd = 1 THEN cast(f.tou_num AS decimal(28, 10)) END), 0) AS l,
        coalesce(sum(CASE WHEN f.tou_div_cd = 2 THEN cast(f.tou_num AS decimal(28, 10)) END), 0) AS o,
        coalesce(sum(CASE WHEN f.tou_div_cd = 3 THEN cast(f.tou_num AS decimal(28, 10)) END), 0) AS x
      FROM {{{feed}}} f JOIN {{districts}} d ON d.code = f.signgu_code GROUP BY 1, 2, 3),
    dense AS (SELECT c.city_name_en, c.y, g.m, cast(day(last_day(make_date(c.y, g.m, 1))) AS int) AS days,
        cast(coalesce(s.l, 0) AS double) AS l, cast(coalesce(s.o, 0) AS double) AS o, cast(coalesce(s.x, 0) AS double) AS x,
        cast(coalesce(s.l + s.o + s.x, 0) AS double) AS t, s.m IS NOT NULL AS has_data
      FROM (SELECT DISTINCT city_name_en, y FROM sums) c CROSS JOIN generate_series(1, 12) g(m)
        LEFT JOIN sums s ON s.city_name_en = c.city_name_en AND s.y = c.y AND s.m = g.m),
    monthly AS (SELECT city_name_en, cast(y AS int) AS year, concat(cast(y AS string), '-', lpad(cast(m AS string), 2, '0')) AS month, days,
        {_cents('l')} AS locals_total, {_cents('l / days')} AS locals_daily_avg, {_cents('o')} AS out_of_town_total,
        {_cents('o / days')} AS out_of_town_daily_avg, {_cents('x')} AS foreigners_total, {_cents('x / days')} AS foreigners_daily_avg,
        {_cents('t')} AS total_visitors, {_cents('t / days')} AS total_daily_avg, has_data FROM dense)
    """


DAILY, SHIPMENTS = _monthly_sql("daily"), _monthly_sql("shipments")
MEASURES = """city_name_en, year, month, days, locals_total, locals_daily_avg, out_of_town_total, out_of_town_daily_avg,
      foreigners_total, foreigners_daily_avg, total_visitors, total_daily_avg"""


def _mapped(t, feed="daily"):
    return visitors.daily_by_city(t[feed], t["districts"])


def _sparse(feed_sql: str) -> str:
    # Months with any row of a known segment.
    return f"{feed_sql} SELECT {MEASURES} FROM monthly WHERE has_data"


@query(_sparse(DAILY.replace("FROM {daily} f JOIN", "FROM (SELECT * FROM {daily} WHERE tou_div_cd <= 3) f JOIN")))
def visitor_monthly(t):
    """Monthly statistics of the months with data (events feed)."""
    return visitors.monthly_statistics(_mapped(t))


@query(_sparse(SHIPMENTS.replace("FROM {shipments} f JOIN", "FROM (SELECT * FROM {shipments} WHERE tou_div_cd <= 3) f JOIN")))
def visitor_monthly_shipments(t):
    """The same over the largest table, several years."""
    return visitors.monthly_statistics(_mapped(t, "shipments"))


@query(f"{SHIPMENTS} SELECT {MEASURES} FROM monthly")
def visitor_calendar(t):
    """Dense twelve-month statistics per city and year."""
    return visitors.dense_statistics(_mapped(t, "shipments"))


ANNUAL = f"""
    , annual AS (SELECT city_name_en, year, cast(sum(days) AS int) AS days,
        cast(sum(cast(locals_total AS decimal(28, 10))) AS double) AS l, cast(sum(cast(out_of_town_total AS decimal(28, 10))) AS double) AS o,
        cast(sum(cast(foreigners_total AS decimal(28, 10))) AS double) AS x, cast(sum(cast(total_visitors AS decimal(28, 10))) AS double) AS t
      FROM monthly GROUP BY 1, 2)
    SELECT city_name_en, year, days, {_cents('l')} AS locals_total, {_cents('o')} AS out_of_town_total, {_cents('x')} AS foreigners_total,
      {_cents('t')} AS total_visitors, {_cents('l / days')} AS locals_daily_avg, {_cents('o / days')} AS out_of_town_daily_avg,
      {_cents('x / days')} AS foreigners_daily_avg, {_cents('t / days')} AS total_visitors_daily_avg FROM annual
"""


@query(SHIPMENTS + ANNUAL)
def visitor_annual(t):
    """Annual totals and daily averages."""
    return visitors.annual_statistics(visitors.dense_statistics(_mapped(t, "shipments")))


@query(DAILY + f"SELECT {MEASURES} FROM monthly WHERE city_name_en NOT IN ('NATION_1', 'NATION_2')")
def visitor_resume(t):
    """Cities with twelve stored months are not collected again."""
    mapped = _mapped(t)
    stored = visitors.dense_statistics(mapped.where(F.col("city_name_en").isin("NATION_1", "NATION_2")))
    return visitors.dense_statistics(visitors.skip_complete(mapped, stored))


@query(DAILY + f"""
    SELECT {MEASURES} FROM monthly WHERE city_name_en = 'NATION_3'
    UNION ALL SELECT city_name_en, year, month, days, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0 FROM monthly WHERE city_name_en <> 'NATION_3'""")
def visitor_refresh(t):
    """Newly collected statistics replace the stored ones of their city."""
    mapped = _mapped(t)
    stored = visitors.dense_statistics(mapped.withColumn("tou_div_cd", F.lit(9)))
    new = visitors.dense_statistics(mapped.where(F.col("city_name_en") == "NATION_3"))
    return visitors.replace_statistics(stored, new)


@query(DAILY + """
    SELECT city_name_en, year, count(*) AS months, min(month) AS first_month, max(month) AS last_month,
      round(sum(total_visitors), 2) AS total_visitors FROM monthly GROUP BY 1, 2""")
def visitor_envelope(t):
    """Nested yearly rows, read back."""
    nested = visitors.statistics_envelope(visitors.dense_statistics(_mapped(t)))
    m = F.col("monthly_statistics")
    return nested.select(
        "city_name_en", "year",
        F.size(m).cast("long").alias("months"),
        m[0]["month"].alias("first_month"),
        F.get(m, F.size(m) - 1)["month"].alias("last_month"),
        F.col("annual_totals")["total_visitors"].alias("total_visitors"),
    )


FINAL = """
    WITH meta AS (SELECT n_name AS city_name_en, arg_max(s_name, s_suppkey) AS title FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
        WHERE n_nationkey < 20 GROUP BY 1),
    stats AS (SELECT d.city_name_en, count(DISTINCT concat(cast(year(f.date) AS string), '-', cast(month(f.date) AS string))) AS n
        FROM {daily} f JOIN {districts} d ON d.code = f.signgu_code WHERE f.tou_div_cd <= 3 GROUP BY 1),
    final AS (SELECT coalesce(m.city_name_en, s.city_name_en) AS city_name_en, m.title, coalesce(s.n, 0) AS stat_months,
        CASE WHEN m.city_name_en IS NULL THEN 'visitor_only' WHEN s.city_name_en IS NULL THEN 'wikipedia_only' ELSE 'merged' END AS outcome,
        CASE WHEN m.city_name_en IS NULL THEN 'incomplete' END AS meta_status, CASE WHEN s.city_name_en IS NULL THEN 'incomplete' END AS statistics_status
      FROM meta m FULL JOIN stats s ON s.city_name_en = m.city_name_en)
"""


def _final(t):
    named = t.sql(
        "SELECT n_name AS city_name_en, s_name AS title, s_suppkey AS pos FROM {supplier} JOIN {nation} "
        "ON n_nationkey = s_nationkey WHERE n_nationkey < 20"
    )
    months = visitors.monthly_statistics(_mapped(t))
    stats = months.groupBy("city_name_en").agg(F.count("*").alias("stat_months"))
    return visitors.final_cities(visitors.last_city_per_name(named, "pos"), stats)


@query(FINAL + "SELECT city_name_en, title, stat_months, outcome, meta_status, statistics_status FROM final")
def city_final_merge(t):
    """City metadata and statistics side by side."""
    return _final(t).select(
        "city_name_en", "meta.title",
        F.coalesce("visitor_statistics.stat_months", F.lit(0)).alias("stat_months"),
        "outcome", "meta_status", "statistics_status",
    )


@query(FINAL + """
    SELECT count(CASE outcome WHEN 'merged' THEN 1 END) AS merged_count, count(CASE outcome WHEN 'wikipedia_only' THEN 1 END) AS wikipedia_only_count,
      count(CASE outcome WHEN 'visitor_only' THEN 1 END) AS visitor_only_count, count(*) AS total FROM final""")
def merge_outcomes(t):
    """Counts of the final merge."""
    return visitors.merge_outcomes(_final(t))


CLIMATE_CITIES = """
    SELECT c_custkey, c_name AS city_name_ko, concat('R', cast(c_nationkey AS string)) AS prefecture_id,
      CASE c_custkey % 3 WHEN 0 THEN '수작업 필요' WHEN 1 THEN 'own' END AS caption,
      CASE WHEN c_custkey % 5 = 0 THEN 'needs_review' ELSE 'collected' END AS status FROM {customer}
"""
CLIMATE_REGIONS = """
    SELECT concat('R', cast(n_nationkey AS string)) AS prefecture_id, n_name AS name_ko, concat('u', n_name) AS source_url,
      CASE n_nationkey % 3 WHEN 0 THEN '수작업 필요' ELSE 'regional' END AS caption,
      CASE WHEN n_nationkey % 7 = 0 THEN 'needs_review' ELSE 'collected' END AS status FROM {nation}
"""


@query(f"""
    WITH c AS ({CLIMATE_CITIES}), r AS ({CLIMATE_REGIONS})
    SELECT c_custkey, CASE WHEN inherits THEN 'regional' ELSE caption END AS caption,
      CASE WHEN inherits THEN name_ko END AS origin, CASE WHEN inherits THEN source_url END AS source_url,
      CASE WHEN inherits THEN 'collected' ELSE status END AS status
    FROM (SELECT c.*, r.name_ko, r.source_url, NOT coalesce(c.caption = 'own' AND c.status = 'collected', false) AND r.prefecture_id IS NOT NULL AS inherits
      FROM c LEFT JOIN r ON r.prefecture_id = c.prefecture_id AND r.caption = 'regional' AND r.status = 'collected') j""")
def climate_inherit(t):
    """Regional climate tables fill in for missing city tables."""

    def with_maps(df):
        table = F.when(F.col("caption").isNotNull(), F.create_map(F.lit("caption"), F.col("caption")))
        return df.withColumn("climate_table", table).withColumn(
            "field_status", F.create_map(F.lit("climate_table"), F.col("status"))
        )

    out = pages.inherit_climate(with_maps(t.sql(CLIMATE_CITIES)), with_maps(t.sql(CLIMATE_REGIONS)))

    def entry(name):
        return F.try_element_at("climate_table", F.lit(name))

    return out.select(
        "c_custkey", entry("caption").alias("caption"), entry("source_prefecture_name_ko").alias("origin"),
        entry("source_url").alias("source_url"), F.col("field_status")["climate_table"].alias("status"),
    )


# --- merge ------------------------------------------------------------------

IMAGES = "array<struct<url:string,source:string>>"


def _records(df):
    """Unified records from the scalar columns of a view."""
    return df.withColumns(
        {
            "geography_description": F.lit(""),
            "climate_table": F.lit(None).cast("map<string,string>"),
            "site_urls": F.array(F.col("source_url")),
            "image_urls": F.when(
                F.col("image_url").isNotNull(),
                F.array(F.struct(F.concat("image_url", F.lit("/s")).alias("url"), F.lit("list").alias("source"))),
            )
            .otherwise(F.array())
            .cast(IMAGES),
            "field_status": F.create_map(F.lit("city_id"), F.lit("collected")),
            "verified_at": F.lit(None).cast("string"),
            "verified_source_url": F.lit(None).cast("string"),
            "verification_note": F.lit(None).cast("string"),
        }
    )


RANK = "CASE {0}.data_confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END"
LATEST = """
    WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY seq DESC) AS rn FROM {new_cities}) x WHERE rn = 1),
"""


def _field(name: str, text: bool = True) -> str:
    empty = f"trim({name})" if text else f"cast({name} AS string)"
    return (
        f"CASE WHEN old_id IS NULL OR (applies AND coalesce({empty.replace(name, 'n_' + name)}, '') <> '') "
        f"THEN n_{name} ELSE {name} END AS {name}"
    )


def _audit(name: str, previous: str = "source_name", text: bool = True) -> str:
    empty, new_empty = (f"trim({name})", f"trim(n_{name})") if text else (f"cast({name} AS string)", f"cast(n_{name} AS string)")
    new = "CASE WHEN n_source_name = '' THEN 'unknown' ELSE n_source_name END"
    old = f"CASE WHEN coalesce({previous}, '') = '' THEN 'unknown' ELSE {previous} END"
    return (
        f"CASE WHEN old_id IS NULL OR NOT applies OR coalesce({new_empty}, '') = '' THEN NULL "
        f"WHEN coalesce({empty}, '') = '' THEN concat('updated: source=', {new}) "
        f"WHEN {name} <> n_{name} THEN concat('merged: prev_source=', {old}, ', new_source=', {new}) END AS {name}_audit"
    )


NEW_FIELDS = ("city_name_ko", "city_name_en", "location", "latitude", "longitude", "description", "source_name", "source_url", "collected_at", "image_url")
JOINED = LATEST + """
    j AS (SELECT b.*, b.city_id AS old_id, n.city_id AS n_city_id, n.data_confidence AS n_confidence,
        """ + ", ".join(f"n.{f} AS n_{f}" for f in NEW_FIELDS) + f""",
        coalesce({RANK.format('n')} >= {RANK.format('b')} AND n.city_id IS NOT NULL, false) AS applies,
        CASE WHEN n.source_name <> '' AND coalesce({RANK.format('n')} >= {RANK.format('b')}, false) THEN n.source_name ELSE b.source_name END AS source_now
      FROM {{base_cities}} b FULL JOIN latest n ON n.city_id = b.city_id)
"""


@query(JOINED + f"""
    SELECT coalesce(old_id, n_city_id) AS city_id, {_field('city_name_ko')}, {_field('city_name_en')}, {_field('location')},
      {_field('latitude', False)}, {_field('description')}, {_field('source_name')}, {_field('source_url')},
      CASE WHEN old_id IS NULL THEN n_confidence WHEN n_city_id IS NULL THEN data_confidence
        WHEN (CASE n_confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END) > (CASE data_confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END)
        THEN n_confidence ELSE data_confidence END AS data_confidence,
      {_audit('city_name_ko')}, {_audit('latitude', text=False)}, {_audit('source_name')}, {_audit('source_url', 'source_now')}
    FROM j""")
def confidence_merge(t):
    """Latest acquisition of every city merged into the base dataset."""
    from tripweave.operators.keyvalue import pick_per_key

    latest = pick_per_key(t["new_cities"], ["city_id"], F.col("seq")).drop("seq")
    merged = merge.merge_records(_records(t["base_cities"]), _records(latest))
    status = F.col("field_status")
    return merged.select(
        "city_id", "city_name_ko", "city_name_en", "location", "latitude", "description", "source_name",
        "source_url", "data_confidence",
        *[
            F.try_element_at(status, F.lit(n)).alias(f"{n}_audit")
            for n in ("city_name_ko", "latitude", "source_name", "source_url")
        ],
    )


def _image_sql(force: str) -> str:
    return JOINED + f"""
    SELECT coalesce(old_id, n_city_id) AS city_id,
      CASE WHEN old_id IS NULL THEN n_image_url WHEN n_image_url IS NULL THEN image_url
        WHEN image_url IS NULL OR {force} THEN n_image_url ELSE image_url END AS image_url,
      concat_ws(',', CASE WHEN image_url IS NOT NULL THEN concat(image_url, '/s|list') END,
        CASE WHEN NOT {force} AND image_url IS NOT NULL AND n_image_url IS NOT NULL
          THEN concat(n_image_url, '|', CASE WHEN n_source_name = '' THEN 'unknown' ELSE n_source_name END) END,
        CASE WHEN n_image_url IS NOT NULL THEN concat(n_image_url, '/s|list') END) AS images,
      CASE WHEN old_id IS NULL OR n_image_url IS NULL THEN NULL WHEN image_url IS NULL THEN 'updated'
        WHEN {force} THEN 'force_replaced' END AS audit
    FROM j"""


def _image_merge(t, force):
    from tripweave.operators.keyvalue import pick_per_key

    latest = pick_per_key(t["new_cities"], ["city_id"], F.col("seq")).drop("seq")
    merged = merge.merge_records(_records(t["base_cities"]), _records(latest), force)
    listed = F.transform("image_urls", lambda e: F.concat_ws("|", e["url"], e["source"]))
    audit = F.split_part(F.try_element_at("field_status", F.lit("image_url")), F.lit(":"), F.lit(1))
    return merged.select("city_id", "image_url", F.array_join(listed, ",").alias("images"), audit.alias("audit"))


@query(_image_sql("false"))
def image_merge(t):
    """Images are appended, the primary one stays."""
    return _image_merge(t, False)


@query(_image_sql("true"))
def image_merge_forced(t):
    """A forced update replaces the primary image."""
    return _image_merge(t, True)


FOLD = """
    WITH all_rows AS (
      SELECT cast(-1 AS bigint) AS seq, city_id, city_name_ko, location, latitude, description, source_name, source_url, image_url, data_confidence FROM {base_cities}
      UNION ALL SELECT seq, city_id, city_name_ko, location, latitude, description, source_name, source_url, image_url, data_confidence FROM {new_cities}),
    ranked AS (SELECT *, CASE data_confidence WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END AS rnk,
        row_number() OVER w = 1 AS initial FROM all_rows WINDOW w AS (PARTITION BY city_id ORDER BY seq)),
    applied AS (SELECT *, initial OR rnk >= max(rnk) OVER (PARTITION BY city_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS applies FROM ranked),
    vals AS (SELECT *,
        CASE WHEN applies AND trim(city_name_ko) <> '' THEN city_name_ko END AS v_name, CASE WHEN applies AND trim(location) <> '' THEN location END AS v_location,
        CASE WHEN applies THEN latitude END AS v_latitude, CASE WHEN applies AND trim(description) <> '' THEN description END AS v_description,
        CASE WHEN applies AND trim(source_name) <> '' THEN source_name END AS v_source, CASE WHEN applies AND trim(source_url) <> '' THEN source_url END AS v_url,
        CASE WHEN initial OR (applies AND trim(source_name) <> '') THEN source_name END AS s_track FROM applied),
    prevs AS (SELECT *,
        last_value(v_name IGNORE NULLS) OVER p AS p_name, last_value(v_url IGNORE NULLS) OVER p AS p_url, last_value(s_track IGNORE NULLS) OVER p AS p_source
      FROM vals WINDOW p AS (PARTITION BY city_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    events AS (SELECT *, CASE WHEN source_name = '' THEN 'unknown' ELSE source_name END AS src,
        CASE WHEN coalesce(p_source, '') = '' THEN 'unknown' ELSE p_source END AS prev,
        CASE WHEN coalesce(s_track, p_source, '') = '' THEN 'unknown' ELSE coalesce(s_track, p_source) END AS now_source FROM prevs),
    audits AS (SELECT *,
        CASE WHEN initial OR v_name IS NULL THEN NULL WHEN p_name IS NULL THEN concat('updated: source=', src)
          WHEN p_name <> v_name THEN concat('merged: prev_source=', prev, ', new_source=', src) END AS a_name,
        CASE WHEN initial OR v_url IS NULL THEN NULL WHEN p_url IS NULL THEN concat('updated: source=', src)
          WHEN p_url <> v_url THEN concat('merged: prev_source=', now_source, ', new_source=', src) END AS a_url FROM events)
"""


@query(FOLD + """
    SELECT city_id, coalesce(arg_max(v_name, seq), arg_min(city_name_ko, seq)) AS city_name_ko,
      coalesce(arg_max(v_location, seq), first(location ORDER BY seq)) AS location, arg_max(v_latitude, seq) AS latitude,
      coalesce(arg_max(v_description, seq), first(description ORDER BY seq)) AS description,
      coalesce(arg_max(v_source, seq), first(source_name ORDER BY seq)) AS source_name, arg_max(v_url, seq) AS source_url,
      first(data_confidence ORDER BY rnk DESC, seq) AS data_confidence, arg_max(a_name, seq) AS city_name_ko_audit, arg_max(a_url, seq) AS source_url_audit
    FROM audits GROUP BY city_id""")
def incoming_fold(t):
    """All acquisitions of a city applied in order."""
    # Small chunks, so that the carry between chunks is exercised.
    folded = merge.fold_records(_records(t["base_cities"]), _records(t["new_cities"]), chunk_rows=500)
    audit = {n: F.try_element_at("field_status", F.lit(n)).alias(f"{n}_audit") for n in ("city_name_ko", "source_url")}
    return folded.select(
        "city_id", "city_name_ko", "location", "latitude", "description", "source_name", "source_url",
        "data_confidence", *audit.values(),
    )


@query(FOLD + """
    , prim AS (SELECT city_id, first(image_url ORDER BY seq) FILTER (image_url IS NOT NULL) AS p FROM all_rows GROUP BY 1),
    offers AS (SELECT a.city_id, a.image_url AS url, a.seq, 0 AS idx FROM all_rows a JOIN prim USING (city_id) WHERE a.image_url <> p
      UNION ALL SELECT city_id, concat(image_url, '/s'), seq, 1 FROM all_rows WHERE image_url IS NOT NULL)
    SELECT o.city_id, p AS primary_url, url, min(seq) AS seq FROM offers o JOIN prim USING (city_id) GROUP BY 1, 2, 3""")
def image_fold(t):
    """Primary image and distinct image list after all acquisitions."""
    primary, images = merge.fold_images(_records(t["base_cities"]), _records(t["new_cities"]))
    return images.join(primary.withColumnRenamed("image_url", "primary_url"), "city_id").select(
        "city_id", "primary_url", "url", "seq"
    )


@query("""
    SELECT city_id, CASE WHEN bad THEN image_url WHEN src = 'wikipedia' OR image_url IS NULL THEN offer ELSE image_url END AS image_url,
      CASE WHEN image_url IS NULL THEN 0 ELSE 1 END + CASE WHEN bad THEN 0 ELSE 1 END AS images
    FROM (SELECT b.*, k % 9 = 0 AS bad, CASE WHEN k % 9 = 0 THEN 'ftp://x' ELSE concat('https://o.example.com/', cast(k AS string)) END AS offer,
      CASE k % 3 WHEN 0 THEN 'wikipedia' WHEN 1 THEN 'tourapi' ELSE 'blog' END AS src
      FROM (SELECT *, cast(substr(city_id, 4) AS bigint) AS k FROM {base_cities}) b) x""")
def image_offers(t):
    """One offered image per city, by source precedence."""
    k = F.substring("city_id", 4, 20).cast("long")
    offered = _records(t["base_cities"]).withColumns(
        {
            "offer": F.when(k % 9 == 0, F.lit("ftp://x")).otherwise(F.concat(F.lit("https://o.example.com/"), k)),
            "src": F.when(k % 3 == 0, "wikipedia").when(k % 3 == 1, "tourapi").otherwise("blog"),
        }
    )
    return merge.apply_image(offered, "offer", "src").select("city_id", "image_url", F.size("image_urls").alias("images"))


@query("""
    SELECT city_id, CASE WHEN n.city_id IS NULL THEN b.city_name_ko ELSE n.city_name_ko END AS city_name_ko,
      CASE WHEN n.city_id IS NULL THEN b.source_name ELSE n.source_name END AS source_name
    FROM {base_cities} b FULL JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY seq DESC) AS rn FROM {new_cities}) x WHERE rn = 1) n
      USING (city_id)""")
def record_replace(t):
    """Newly acquired records replace existing ones as a whole."""
    return merge.replace_records(t["base_cities"], t["new_cities"], "seq").select("city_id", "city_name_ko", "source_name")


@query("""
    WITH firsts AS (SELECT city_name_ko, min(seq) AS seq FROM {new_cities} GROUP BY 1)
    SELECT o.o_orderkey, f.seq AS first_seq FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
      LEFT JOIN firsts f ON f.city_name_ko = concat('city ', c.c_mktsegment)""")
def detail_match(t):
    """Detail files matched to the first city of the same name."""
    details = t.sql(
        "SELECT o_orderkey, concat('city ', c_mktsegment) AS city_name_ko FROM {orders} JOIN {customer} ON c_custkey = o_custkey"
    )
    cities = t["new_cities"].withColumn("city_id", F.col("seq").cast("string"))
    return merge.match_details(details, cities, "seq").select(
        "o_orderkey", F.col("city_id").cast("long").alias("first_seq")
    )


@query("""
    SELECT count(*) AS records_processed FROM {new_cities} WHERE city_id IN (SELECT city_id FROM {base_cities})""")
def known_details(t):
    """Acquisitions that belong to a known city."""
    return merge.count_known(t["new_cities"], t["base_cities"])


# --- quality ----------------------------------------------------------------

EVALUATED = """
    WITH flagged AS (SELECT *, coalesce(trim(city_name_ko), '') = '' AS f_name, prefecture_id = '' AS f_pref, latitude IS NULL AS f_lat, longitude IS NULL AS f_lon,
        description = '' AS f_desc, coalesce(image_url, '') = '' AS f_img FROM {base_cities}),
    evaluated AS (SELECT *, CASE WHEN f_name OR f_pref THEN 'low' WHEN f_lat OR f_lon OR f_desc THEN 'medium' ELSE 'high' END AS confidence,
        concat_ws(',', CASE WHEN f_name THEN 'city_name_ko' END, CASE WHEN f_pref THEN 'prefecture_id' END, CASE WHEN f_lat THEN 'latitude' END,
          CASE WHEN f_lon THEN 'longitude' END, CASE WHEN f_desc THEN 'description' END) AS missing,
        concat_ws(',', CASE WHEN f_lat OR f_lon THEN 'missing_coordinates' END, CASE WHEN f_desc THEN 'empty_description' END,
          CASE WHEN f_name OR f_pref THEN 'low_confidence' END) AS reasons FROM flagged),
    review AS (SELECT *, CASE WHEN f_lat OR f_lon THEN 'missing_coordinates' WHEN f_desc THEN 'empty_description' WHEN f_img THEN 'no_image_url'
        ELSE 'low_confidence' END AS review_reason FROM evaluated WHERE confidence = 'low')
"""


def _evaluated(t):
    return quality.evaluate_completeness(_records(t["base_cities"]))


@query(EVALUATED + """
    SELECT city_id, confidence AS data_confidence, missing, reasons, confidence = 'low' AS needs_review,
      CASE WHEN f_lat THEN 'needs_review' ELSE 'collected' END AS latitude_status FROM evaluated""")
def completeness(t):
    """Completeness of every city record."""
    c = F.col("completeness")
    return _evaluated(t).select(
        "city_id", c["data_confidence"].alias("data_confidence"), F.array_join(c["missing_fields"], ",").alias("missing"),
        F.array_join(c["review_reasons"], ",").alias("reasons"), c["needs_review"].alias("needs_review"),
        c["field_statuses"]["latitude"].alias("latitude_status"),
    )


@query(EVALUATED + """
    SELECT city_id, CASE WHEN confidence = 'medium' THEN data_confidence ELSE confidence END AS data_confidence,
      CASE confidence WHEN 'low' THEN CASE WHEN f_desc THEN 'needs_review' ELSE 'collected' END WHEN 'high' THEN 'collected' END AS description_status,
      CASE WHEN confidence = 'low' AND f_img THEN 'needs_review' WHEN confidence = 'high' AND NOT f_img THEN 'collected' END AS image_status
    FROM evaluated""")
def review_transition(t):
    """Evaluation written back to the records."""
    status = F.col("field_status")
    return quality.apply_review(_evaluated(t)).select(
        "city_id", "data_confidence",
        F.try_element_at(status, F.lit("description")).alias("description_status"),
        F.try_element_at(status, F.lit("image_url")).alias("image_status"),
    )


@query(EVALUATED + """
    SELECT city_id, city_name_ko, prefecture_id, concat_ws(',', missing, CASE WHEN f_img THEN 'image_url' END) AS missing_fields, review_reason FROM review""")
def review_manifest(t):
    """Review entries of low-confidence records."""
    return quality.review_entries(_evaluated(t)).select(
        "city_id", "city_name_ko", "prefecture_id", F.array_join("missing_fields", ",").alias("missing_fields"), "review_reason"
    )


@query(EVALUATED + "SELECT review_reason, count(*) AS entry_count FROM review GROUP BY 1")
def review_reason_counts(t):
    """Review entries per reason."""
    return quality.reason_counts(quality.review_entries(_evaluated(t)))


@query(EVALUATED + """
    SELECT count(*) AS records_processed, count(CASE WHEN confidence <> 'medium' OR missing <> '' THEN 1 END) AS records_updated FROM evaluated""")
def stage_counters(t):
    """Processed and updated counts of a stage."""
    return quality.stage_counters(_evaluated(t))


ERROR_TEXT = """
    SELECT event_id, concat(CASE event_type WHEN 'view' THEN 'HTTP 503 from host' WHEN 'click' THEN 'Connection reset' WHEN 'error' THEN 'cannot decode'
      WHEN 'signup' THEN 'strange' ELSE 'API Timeout' END, ' ', props) AS message FROM {events}
"""
CATEGORY = """CASE WHEN regexp_matches(lower(message), 'api|status code|401|403|429|500|502|503') THEN 'api'
      WHEN regexp_matches(lower(message), 'network|timeout|connection|socket|dns|unreachable') THEN 'network'
      WHEN regexp_matches(lower(message), 'parse|json|decode|keyerror|format|invalid syntax') THEN 'parsing' ELSE 'other' END"""


@query(f"SELECT category, count(*) AS error_count FROM (SELECT {CATEGORY} AS category FROM ({ERROR_TEXT}) e) c GROUP BY 1")
def error_categories(t):
    """Errors per category."""
    return t.sql(ERROR_TEXT).groupBy(error_category(F.col("message")).alias("category")).agg(F.count("*").alias("error_count"))


@query(EVALUATED + f"""
    SELECT (SELECT count(*) FROM {{base_cities}}) AS total_records_processed, (SELECT count(*) FROM review) AS records_transitioned_to_review,
      (SELECT count(*) FROM {{events}}) AS total_errors, (SELECT count(*) FROM review WHERE review_reason = 'missing_coordinates') AS without_coordinates,
      (SELECT count(*) FROM ({ERROR_TEXT}) e WHERE {CATEGORY} = 'network') AS network_errors,
      cast((SELECT sum(CASE WHEN image_url IS NULL THEN 0 ELSE 1 END) FROM {{base_cities}}) AS bigint) AS total_images_collected""")
def run_report(t):
    """Totals and breakdowns of a run in one row."""
    records = _records(t["base_cities"])
    stages = records.groupBy(F.lit("wikipedia").alias("stage_name")).agg(F.count("image_url").alias("images_collected"))
    report = quality.run_report(records, stages, quality.review_entries(_evaluated(t)), t.sql(ERROR_TEXT))
    return report.select(
        "total_records_processed", "records_transitioned_to_review", "total_errors",
        F.col("review_reason_counts")["missing_coordinates"].alias("without_coordinates"),
        F.col("error_counts")["network"].alias("network_errors"), "total_images_collected",
    )
