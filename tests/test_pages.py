import duckdb
from pyspark.sql import functions as F

from tripweave.functions import text as X
from tripweave.functions.html import whole_references
from tripweave.operators import pages
from tripweave.sources import dimensions
from tripweave.workloads import QUERIES, TWINS



def row_of(tag, cells):
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


MONTH_NAMES = [f"{m}월" for m in range(1, 13)]
# Two invented towns, one in each page layout.
HARBOUR = (
    '<html><body><h1 id="firstHeading">모래시</h1><div class="mw-parser-output"><span class="geo-dec">1; 1</span></div>'
    '<div id="mw-content-text"><div class="mw-parser-output"><span class="geo-dec">34.525; 126.25</span>'
    "<p><i>모래시</i>는 대한민국 전라남도에 위치한 포구 마을이다.</p><p></p><p>소금으로 이름났다.</p>"
    "<h2>기후</h2><p>바람이 세다.</p>"
    "<table class='infobox'>" + row_of("th", ["2월 기온"]) + "</table>"
    '<table class="wikitable"><caption>모래시 기온표[7]</caption>' + row_of("th", ["달", *MONTH_NAMES, "연간"])
    + "<tr><td>평균 기온 (°C)</td><td>−2.5[9]</td>" + "<td>3.5</td>" * 10 + '<td colspan="1">-0.5</td><td>2,040</td></tr>'
    + row_of("td", ["한 칸"]) + "</table>"
    '<h2><span class="mw-headline" id="지리">지리</span><span>[편집]</span></h2><p>갯벌이 넓게 펼쳐진다.</p>'
    '<ul><li><a href="https://www.morae.go.kr/">안내</a></li></ul><p><a class="external text" href="https://www.morae.go.kr/">다시 안내</a></p></div></div>'
    '<a hreflang="en" href="/wiki/Morae_town">English</a></body></html>'
)
VALLEY = (
    '<h1 id="firstHeading">들판군</h1><div id="mw-content-text"><div class="mw-parser-output">'
    '<a href="https://geohack.toolforge.org/geohack.php?pagename=y&amp;params=35.25_N_127.5_E_type:city">위치</a>'
    '<section data-mw-section-id="0"><p>들이 넓은 고장</p></section>'
    '<section data-mw-section-id="1" aria-labelledby="역사"><p>옛터가 있다.</p></section>'
    '<section data-mw-section-id="2"><h2 id="y">지리</h2><p>맑은내가 흐른다.</p><section data-mw-section-id="3"><h3>산</h3><p>푸른재가 높다.</p></section></section>'
    '<section data-mw-section-id="4"><h2>교통</h2></section></div></div>'
)


def parsed(spark, *html):
    df = spark.createDataFrame([(i, h, "") for i, h in enumerate(html)], "page int, html string, prefecture_id string")
    return pages.parse_pages(df, fallback_title=F.lit("대체")).orderBy("page")


def test_legacy_page(spark):
    row = parsed(spark, HARBOUR).first()
    assert row["title"] == "모래시"
    assert row["extract"] == "모래시는 대한민국 전라남도에 위치한 포구 마을이다.\n\n소금으로 이름났다."
    assert tuple(row["coordinates"]) == (34.525, 126.25)
    assert row["extlinks"] == ["https://www.morae.go.kr/"] and [tuple(l) for l in row["langlinks"]] == [("en", "Morae town")]
    assert row["content"] == "== 기후 ==\n바람이 세다.\n\n== 지리 ==\n갯벌이 넓게 펼쳐진다.\n\n다시 안내"
    table = row["climate_table"]
    assert table["caption"] == "모래시 기온표" and table["wikitext"].startswith('{| class="wikitable"\n|+ 모래시 기온표[7]\n|-\n! 달 !! 1월')
    assert '|| colspan="1" | -0.5 ||' in table["wikitext"] and table["wikitext"].endswith("| 한 칸\n|}")
    cells = {(c["month"], c["label"]): c["value"] for c in row["climate_data"]}
    assert len(cells) == 13 and cells["1월", "평균 기온"] == "-2.5" and cells["연간", "평균 기온"] == "2040"


def test_section_page_and_map_link(spark):
    row = parsed(spark, VALLEY).first()
    assert row["extract"] == "들이 넓은 고장" and tuple(row["coordinates"]) == (35.25, 127.5)
    assert row["content"] == "== 역사 ==\n옛터가 있다.\n\n== 지리 ==\n맑은내가 흐른다.\n\n푸른재가 높다." and row["climate_table"] is None


def test_broken_pages(spark):
    rows = parsed(spark, "", "<p>no body<div", None).collect()
    assert [r["title"] for r in rows] == ["대체"] * 3 and all(r["extract"] == "" and r["content"] == "" and r["coordinates"] is None for r in rows)


def test_references_without_semicolon_are_text(spark, value):
    html = '<a href="/x?a=1&amp;b=2&c=3">a &amp; b &amp;&amp</a> &lt;&#39;&#3 &x'
    whole = value(whole_references(F.lit(html)))
    assert whole == '<a href="/x?a=1&amp;b=2&amp;c=3">a &amp; b &amp;&amp;amp</a> &lt;&#39;&amp;#3 &amp;x'


def test_page_queries_on_cut_and_quoted_headings(spark, tmp_path):
    heads = ["Sea &amp; sky&amp;&amp", "token = &quot;x&quot;", "Plain &lt;b&gt;", "half &quot"]
    body = "<article><h1>{}</h1><p>{} &quot;q&quot; &amp</p></article>"
    rows = [(i, f"http://h/{i}", body.format(h, h)) for i, h in enumerate(heads)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([("Nation",)], "n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("page_parse", "page_records"):
        found = QUERIES[name](spark, str(tmp_path))
        want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({TWINS[name]}) q").fetchall()
        assert sorted(map(tuple, found.collect())) == sorted(want), name


def test_korean_city_records(spark):
    names = spark.createDataFrame([("모래시", "MORAE"), ("바위군 (대한민국)", "BAWI")], "city_name_ko string, city_name_en string")
    page = '<h1 id="firstHeading">바위군 (대한민국)</h1><div class="mw-parser-output"></div>'
    records = pages.korean_city_records(parsed(spark, HARBOUR, page), names, F.lit("now"))
    out = {r["city_name_ko"]: r for r in records.collect()}
    c = out["모래시"]
    assert (c["city_id"], c["prefecture_id"], c["location"], c["latitude"]) == ("KR-46-MORAE", "KR-46", "대한민국 전라남도", 34.525)
    assert c["site_urls"] == ["https://www.morae.go.kr/"] and c["geography_description"] == "갯벌이 넓게 펼쳐진다.\n\n다시 안내" and c["data_confidence"] == "medium"
    assert c["field_status"]["climate_table"] == "collected" and c["field_status"]["description"] == "needs_review" and c["field_status"]["city_name_ja"] == "missing"
    d = out["바위군"]
    assert (d["city_id"], d["city_name_en"], d["prefecture_id"], d["data_confidence"]) == ("KR-UNKNOWN-BAWI", "BAWI", "", "low")
    assert d["description"] == "바위군는 대한민국 한국에 속한 지자체이다." and d["geography_description"] == "바위군는 대한민국 한국에 위치한 지자체이다."
    assert d["climate_table"]["caption"] == X.MANUAL_CLIMATE_CAPTION and d["field_status"]["climate_table"] == "needs_review" and d["field_status"]["latitude"] == "missing"
    provinces = dimensions.provinces(spark).withColumnRenamed("province_id", "prefecture_id")
    region = pages.region_records(records.where("prefecture_id <> ''"), provinces, "prefecture_id").collect()
    assert [(r["prefecture_id"], r["name_en"], r["field_status"]["name_ja"]) for r in region] == [("KR-46", "Jeollanam-do", "missing")]


def test_japanese_city_records(spark):
    page = "struct<title:string,extract:string,coordinates:struct<lat:double,lon:double>,extlinks:array<string>,content:string>"
    rows = [
        (("北区 (東京都)", "Kita Tokyo", None, ["https://www.city.kita.lg.jp", "https://blog.x.or.jp"], "== 地理 ==\n川と丘.\n== 気候 ==\n夏は暑い."), None, ("北区 (東京都)", "", None, [], ""), ("Kita, Tokyo", None, (35.75, 139.5), [], None), "ja", ""),
        (("네리마구 (도쿄도)", "도쿄도의 구.", None, [], ""), ("네리마구 (도쿄도)", "도쿄도의 구.", None, None, ""), None, None, "ko", "JP-13"),
    ]
    df = spark.createDataFrame(rows, f"source {page}, ko {page}, ja {page}, en {page}, lang string, prefecture_id string")
    out = pages.japanese_city_records(df, F.lit("now")).collect()
    m = out[0]
    assert (m["city_id"], m["city_name_ko"], m["city_name_en"], m["prefecture_id"], m["latitude"]) == ("JP-13-KITA-TOKYO", "기타구", "Kita, Tokyo", "JP-13", 35.75)
    assert m["geography_description"] == "川と丘." and m["climate_table"]["caption"] == "気候" and m["site_urls"] == ["https://www.city.kita.lg.jp"]
    assert m["field_status"]["city_name_ko"] == "needs_review" and m["description"] == "기타구는 일본 도쿄도에 속한 지자체이다."
    c = out[1]
    assert c["city_name_ko"] == "네리마구" and c["field_status"]["city_name_ko"] == "collected" and c["field_status"]["city_name_en"] == "missing"
    assert c["geography_description"] == "네리마구는 일본 도쿄도에 위치한 지자체이다." and c["location"] == "일본 도쿄도"


def test_climate_inheritance(spark):
    schema = "prefecture_id string, city_name_ko string, climate_table map<string,string>, field_status map<string,string>"
    cities = spark.createDataFrame(
        [("JP-13", "a", {"caption": "수작업 필요"}, {"climate_table": "needs_review", "x": "y"}), ("JP-13", "b", {"caption": "own"}, {"climate_table": "collected"}), ("JP-14", "c", None, {})], schema
    )
    regions = spark.createDataFrame(
        [("JP-13", "도쿄도", "u", {"caption": "도쿄의 기후"}, {"climate_table": "collected"}), ("JP-14", "x", "u", {"caption": "수작업 필요"}, {"climate_table": "collected"})],
        "prefecture_id string, name_ko string, source_url string, climate_table map<string,string>, field_status map<string,string>",
    )
    out = {r["city_name_ko"]: r for r in pages.inherit_climate(cities, regions).collect()}
    assert out["a"]["climate_table"]["caption"] == "도쿄의 기후" and out["a"]["climate_table"]["source_scope"] == "prefecture" and len(out["a"]["climate_table"]) == 6
    assert out["a"]["field_status"] == {"x": "y", "climate_table": "collected"}
    assert out["b"]["climate_table"] == {"caption": "own"} and out["c"]["climate_table"] is None


def test_region_status(spark):
    row = spark.createDataFrame([("JP-1", "a", "", "c", "r", None, 1.0, "d", "", {"caption": "x"})], "prefecture_id string, name_ko string, name_ja string, name_en string, region string, latitude double, longitude double, description string, geography_description string, climate_table map<string,string>")
    status = row.select(pages.region_field_status().alias("s")).first()["s"]
    assert (status["name_ja"], status["latitude"], status["longitude"], status["description"], status["climate_table"]) == ("missing", "missing", "collected", "needs_review", "collected")
