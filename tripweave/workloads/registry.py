"""Registered queries, their SQL twins and the shared derived inputs.

The benchmark tables are no tourism data, so reference-shaped inputs are
derived from them by SQL that both Spark and the checking engine run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tripweave.session import ship_package

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Derived inputs.  ``{name}`` stands for a table or an earlier view.
VIEWS = {
    # Raw tour records: one per part, in the city of its key.
    "content": """
        SELECT p.p_partkey AS pos, n.n_name AS city_name_en, n.n_nationkey AS city_no,
          concat('KR-', cast(n.n_nationkey AS string)) AS city_id,
          CASE WHEN n.n_nationkey = 24 THEN '' ELSE r.r_name END AS province,
          CASE WHEN p.p_partkey % 89 = 5 THEN '' ELSE cast(p.p_partkey AS string) END AS contentid,
          CASE p.p_partkey % 6 WHEN 0 THEN '12' WHEN 1 THEN '14' WHEN 2 THEN '15'
            WHEN 3 THEN '28' WHEN 4 THEN '39' ELSE '25' END AS contenttypeid,
          CASE WHEN p.p_partkey % 97 = 7 THEN '' ELSE p.p_name END AS title,
          CASE WHEN p.p_partkey % 41 = 3 THEN 'x' WHEN p.p_partkey % 43 = 3 THEN '0'
            ELSE concat(cast(120 + p.p_partkey % 16 AS string), '.25') END AS mapx,
          concat(cast(30 + p.p_partkey % 12 AS string), '.5') AS mapy,
          CASE WHEN p.p_partkey % 13 = 1 THEN '' ELSE p.p_type END AS lcls,
          CASE WHEN p.p_partkey % 11 = 2 THEN '' ELSE p.p_brand END AS cat3,
          CASE WHEN p.p_partkey % 17 = 4 THEN '' ELSE concat('C0', cast(p.p_size % 3 AS string)) END AS lcls1,
          CASE WHEN p.p_partkey % 7 = 0 THEN '' ELSE concat('https://img.example.com/a', cast(p.p_partkey AS string),
            CASE p.p_size % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG?w=1' WHEN 2 THEN '.gif' ELSE '' END) END AS firstimage,
          CASE WHEN p.p_partkey % 5 = 0 THEN concat('https://img.example.com/b', cast(p.p_partkey AS string), '.jpg')
            ELSE '  ' END AS firstimage2,
          CASE WHEN p.p_partkey % 3 = 0 THEN concat('054-', cast(p.p_size AS string)) ELSE ' ' END AS tel,
          CASE WHEN p.p_partkey % 4 = 0 THEN concat(' ', p.p_brand, ' street ') ELSE '' END AS addr1,
          concat('about ', p.p_name, ' ', p.p_brand) AS overview,
          coalesce(replace(substr(cast(o.o_orderdate AS string), 1, 10), '-', ''), '') AS start_ymd,
          CASE WHEN o.o_orderkey % 4 = 0 THEN '' ELSE coalesce(substr(cast(cast(o.o_orderdate AS date)
            + cast(o.o_orderkey % 120 AS int) AS string), 1, 10), '') END AS end_iso
        FROM {part} p JOIN {nation} n ON n.n_nationkey = p.p_partkey % 25
          JOIN {region} r ON r.r_regionkey = n.n_regionkey
          LEFT JOIN {orders} o ON o.o_orderkey = p.p_partkey""",
    # Classification dictionary; one type is left unmapped.
    "classes": """
        SELECT p_type AS code, lower(p_type) AS name,
          CASE WHEN p_type IN ('ECONOMY', 'MEDIUM', 'PROMO') THEN 'Attraction'
            WHEN p_type = 'LARGE' THEN 'Festival' ELSE 'Restaurant' END AS type,
          concat('theme-', lower(p_type)) AS theme
        FROM {part} WHERE p_type <> 'SMALL' GROUP BY p_type""",
    # Theme mapping records of one theme file.
    "mapping": """
        SELECT p_partkey AS ordinal, p_type AS code, p_name AS name,
          CASE p_partkey % 4 WHEN 0 THEN '바다·해안' WHEN 1 THEN '역사·전통' WHEN 2 THEN '기타' ELSE '미식·노포' END AS theme,
          CASE WHEN p_partkey % 5 = 0 THEN '체험관광' ELSE p_brand END AS large_category,
          CASE WHEN p_partkey % 7 = 0 THEN '교육시설' ELSE '' END AS middle_category
        FROM {part}""",
    # Daily visitor feed: segment 1-3 by event type, others unknown.
    "daily": """
        SELECT concat('D', cast(user_id % 25 AS string)) AS signgu_code, cast(ts AS date) AS date,
          CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 9 END AS tou_div_cd,
          value AS tou_num
        FROM {events}""",
    "shipments": """
        SELECT concat('D', cast(l_suppkey % 25 AS string)) AS signgu_code, cast(l_shipdate AS date) AS date,
          l_linenumber AS tou_div_cd, l_extendedprice AS tou_num
        FROM {lineitem}""",
    # District codes; two of the 25 districts are not mapped.
    "districts": """
        SELECT concat('D', cast(n_nationkey AS string)) AS code, concat('ko-', n_name) AS city_name_ko,
          n_name AS city_name_en, concat('KR-', cast(11 + n_regionkey AS string)) AS province_id
        FROM {nation} WHERE n_nationkey NOT IN (7, 11)""",
    # City records of an existing dataset and of a new acquisition.
    "base_cities": """
        SELECT concat('KR-', cast(s_suppkey AS string)) AS city_id,
          CASE WHEN s_suppkey % 11 = 0 THEN ' ' ELSE s_name END AS city_name_ko, '' AS city_name_ja,
          upper(s_name) AS city_name_en,
          CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE concat('KR-', cast(11 + s_nationkey AS string)) END AS prefecture_id,
          CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'south' END AS location,
          CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal END AS latitude,
          CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal + 1 END AS longitude,
          CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE concat('about ', s_name) END AS description,
          CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE concat('https://a.example.com/', cast(s_suppkey AS string)) END AS image_url,
          CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE 'wikipedia' END AS source_name,
          concat('https://w.example.com/', cast(s_suppkey AS string)) AS source_url,
          '2026-01-01' AS collected_at,
          CASE s_suppkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS data_confidence
        FROM {supplier}""",
    # Several acquisitions per city, in customer order.
    "new_cities": """
        SELECT c_custkey AS seq, concat('KR-', cast(c_custkey % 120 AS string)) AS city_id,
          CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('city ', c_mktsegment) END AS city_name_ko, '' AS city_name_ja,
          CASE WHEN c_custkey % 9 = 0 THEN ' ' ELSE c_mktsegment END AS city_name_en,
          concat('KR-', cast(11 + c_nationkey AS string)) AS prefecture_id,
          CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'north' END AS location,
          CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS latitude,
          c_acctbal + 2 AS longitude,
          CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('seen by ', c_name) END AS description,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('https://b.example.com/', cast(c_custkey % 30 AS string)) END AS image_url,
          CASE WHEN c_custkey % 10 = 0 THEN '' ELSE concat('feed-', c_mktsegment) END AS source_name,
          concat('https://f.example.com/', cast(c_custkey AS string)) AS source_url,
          concat('2026-02-', cast(10 + c_custkey % 18 AS string)) AS collected_at,
          CASE c_custkey % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'odd' END AS data_confidence
        FROM {customer}""",
    # Keyed items: the loadable part of the content records.
    "items": """
        SELECT concat('CITY#', city_name_en) AS PK,
          concat(CASE WHEN contenttypeid = '15' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END, contentid) AS SK,
          CASE WHEN contenttypeid = '15' THEN 'festival' ELSE 'attraction' END AS entity_type,
          contentid AS content_id, city_id, city_name_en, concat('ko-', city_name_en) AS city_name_ko, province,
          CASE WHEN pos % 19 = 0 THEN NULL ELSE concat('PROVINCE#', CASE WHEN province = '' THEN 'UNKNOWN' ELSE province END)
            END AS province_key,
          concat('CITY#', city_name_en) AS city_key,
          concat(CASE WHEN contenttypeid = '15' THEN 'FESTIVAL#' ELSE 'ATTRACTION#' END, contentid) AS domain_sort_key,
          CASE WHEN contenttypeid = '15' THEN concat('FESTIVAL#',
            CASE WHEN pos % 10 = 2 OR start_ymd = '' THEN '00' ELSE substr(start_ymd, 5, 2) END, '#', contentid) END AS gsi_sk,
          title, overview AS description, cat3 AS theme, addr1 AS address,
          start_ymd AS event_start_date, end_iso AS event_end_date, firstimage AS image_url,
          CASE WHEN pos % 9 = 0 THEN 'review' WHEN pos % 5 = 0 THEN '' ELSE 'passed' END AS quality_status,
          CASE pos % 4 WHEN 0 THEN 'succeeded' WHEN 2 THEN 'failed' END AS classified,
          CASE WHEN pos % 8 = 0 THEN '' ELSE concat('2026-0', cast(1 + pos % 9 AS string), '-01T00:00:00Z') END AS updated_at,
          concat('2025-0', cast(1 + pos % 9 AS string), '-01T00:00:00Z') AS collected_at,
          cast(mapy AS double) AS latitude, pos
        FROM {content} WHERE contentid <> '' AND contenttypeid IN ('12', '14', '15', '28')""",
    # Places: one per customer; a third lie around one spot, some at the antimeridian, at a pole or nowhere.
    "places": """
        SELECT concat('P', cast(c_custkey AS string)) AS place, c_name AS title, concat('KR-', cast(c_nationkey AS string)) AS city_id,
          CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN cast(c_custkey % 101 AS double) / 20000 + 37.5
            WHEN c_custkey % 53 = 1 THEN cast(c_custkey % 7 AS double) / 100 + 89.9
            WHEN c_custkey % 47 = 1 THEN 45.0 ELSE cast(c_custkey * 37 % 1000 AS double) / 200 + 33 END AS latitude,
          CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN cast(c_custkey % 211 AS double) / 20000 + 127
            WHEN c_custkey % 53 = 1 THEN cast(c_custkey % 360 AS double) - 180
            WHEN c_custkey % 47 = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN -180.0 ELSE 180.0 END
            ELSE cast(c_custkey * 61 % 1000 AS double) / 200 + 125 END AS longitude,
          split(CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat(lower(c_mktsegment), CASE WHEN c_custkey % 3 = 0 THEN ',food' ELSE '' END,
            CASE WHEN c_custkey % 5 = 0 THEN ',sea' ELSE '' END) END, ',') AS themes,
          split(CASE WHEN c_custkey % 13 = 0 THEN '' ELSE concat(cast(c_custkey % 12 + 1 AS string), ',',
            cast(c_custkey * 7 % 12 + 1 AS string)) END, ',') AS months,
          CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS rank,
          CASE WHEN c_custkey % 4 = 0 THEN cast('2024-11-05' AS date) + cast(c_custkey % 400 AS int) END AS event_start_date,
          CASE WHEN c_custkey % 8 = 0 THEN cast('2024-11-05' AS date) + cast(c_custkey % 400 + c_custkey % 50 AS int) END AS event_end_date,
          CASE WHEN c_custkey % 9 = 0 THEN ' ' ELSE concat('about ', c_name) END AS description,
          CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS address,
          CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('https://img.example.com/', cast(c_custkey AS string)) END AS image_url,
          CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE abs(c_acctbal) / 6113 END AS distance
        FROM {customer}""",
}


class Inputs:
    """Tables and derived views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        ship_package(spark)

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.sql(VIEWS[name])

    def sql(self, text: str) -> DataFrame:
        names = [n for n in (*TABLES, *VIEWS) if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: self[n] for n in names})

    @cached_property
    def payloads(self) -> DataFrame:
        from tripweave.workloads.payloads import raw_payloads

        return raw_payloads(self)


def twin(text: str) -> str:
    """SQL for the checking engine: used views become common table expressions."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if "{" + name + "}" in sql:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(text)

    def plain(sql: str) -> str:
        for name in (*TABLES, *VIEWS):
            sql = sql.replace("{" + name + "}", name)
        return sql

    body = plain(text).strip()
    if not needed:
        return body
    views = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in needed)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers ``fn(inputs)`` under its name, with its SQL twin if it has one."""

    def register(fn: Callable[[Inputs], DataFrame]) -> Callable:
        name = fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Inputs(spark, folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = twin(sql)
        return fn

    return register
