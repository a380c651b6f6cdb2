import hashlib
import json
import random

from pyspark.sql import functions as F

from tripweave.functions import dates as D
from tripweave.functions import text as X
from tripweave.functions.hashing import attraction_input_hash, festival_input_hash, payload_signature
from tripweave.functions.names import ascii_fold, city_id, name_slug, romanize
from tripweave.functions.numbers import round_cents
from tripweave.sources.dimensions import prefecture_regions, province_regions, tokyo_korean_name

L = F.lit


def test_strip_knows_unicode_space(value):
    assert value(X.strip(L("　  a b\x1c\n")), X.first_non_empty(L(None).cast("string"), L(" "), L(" x "))) == ("a b", "x")
    assert value(X.collapse_whitespace(L(" a　\n b "))) == "a b"


def test_object_names(value):
    assert value(X.safe_object_name(L(" Ho Chi-Minh!"), "U"), X.safe_object_name(L("시"), "city", lower=True)) == ("Ho_Chi-Minh", "city")
    assert value(X.raw_detail_key(L("CHUNCHEON"), L("2026-06-09")), X.raw_detail_key(L("A"), L("2026-6-9"))) == (
        "raw/KR/details/20260609/CHUNCHEON.json", None,
    )
    assert value(X.image_key(L("Cheorwon"), L("Goseokjeong"), L("1"), L(".JPG"))) == "images/KR/Cheorwon/Goseokjeong_1.jpg"


def test_extensions(value):
    assert value(X.url_extension(L("http://x/a.b/c.PNG?z=1")), X.url_extension(L("http://x/a.b/c")), X.url_extension(L("http://x/.jpg"))) == ("PNG", "jpg", "jpg")
    assert value(X.image_extension(L("http://x/a.JPEG#f")), X.image_extension(L("http://x/a.svg")), X.media_type(L(".WebP"))) == ("jpeg", "jpg", "image/webp")


def test_urls(value):
    assert value(X.is_valid_url(L(" https://a.b/c?d=[1] ")), X.is_valid_url(L("https://a b")), X.is_valid_url(L(None).cast("string"))) == (True, False, False)
    links = F.array(L("https://blog.go.kr"), L("https://a.go.kr"), L("https://a.go.kr"), L("https://TOUR.kr/travel"), L("https://b.go.kr"))
    assert value(X.official_urls(links)) == ["https://a.go.kr", "https://TOUR.kr/travel"]
    assert value(X.official_urls(F.array(L("https://city.x.jp"), L("https://a.go.kr")), X.JP_SITE_TOKENS, X.JP_SITE_BLOCKED)) == ["https://city.x.jp"]
    assert value(X.page_url(L("ko"), L("A b/~*")), X.page_url(L("ko"), L(""))) == ("https://ko.wikipedia.org/wiki/A_b/~%2A", "")
    assert value(X.title_from_href(L("https://en.x.org/wiki/A_b+%EC%8B%9C#x")), X.title_from_href(L("/x"))) == ("A b+시", "")


def test_coordinates(value):
    assert value(X.coordinates(L("127.5"), L("36.5"))) == (True, 127.5, 36.5)
    assert value(X.coordinates(L("0"), L("0"))) == (False, 0.0, 0.0)
    assert value(X.coordinates(L("x"), L("36.5"))) == (False, None, None)
    assert value(X.coordinates(L("nan"), L("36.5")))[0] is False
    states = [X.coordinate_status(L(a), L(b)) for a, b in (("127", "36"), ("0", "36"), ("100", "36"), (None, "36"), ("", "1"))]
    assert value(*states) == ("collected", "needs_review", "needs_review", "missing", "missing")


def test_page_coordinates(value):
    at = value(X.geohack_coordinates(L("https://geohack.x/g?params=37_45_12_N_128_54_W")))
    assert abs(at["lat"] - 37.7533333) < 1e-6 and abs(at["lon"] + 128.9) < 1e-9
    assert value(X.geohack_href_coordinates(L("https://geohack.x/g?a=b&params=33.25_N_126.75_E_type:city"))) == (33.25, 126.75)
    assert value(X.template_coordinates(L("x{{좌표|37|45|N|128|54|E|r}}")))["lat"] == 37.75
    assert value(X.template_coordinates(L("none"))) is None
    assert value(X.geo_decimal(L("37.8813; -127.7298"))) == (37.8813, -127.7298)


def test_templates_and_sections(value):
    assert value(X.strip_templates(L("a{{b{{c}}d}}e")), X.strip_templates(L("a}}b{{c")), X.strip_templates(L("plain"))) == ("ae", "a}}b", "plain")
    content = "lead '''x'''<ref>r</ref> ( )\n\n== 지리 ==\n[[A|산]]과 {{t|{{u}}}}강.\n| cell\n\n둘째\n=== 하위 ===\n셋째\n== 기후 ==\n{|\n|+ 표 <b>1</b>\n|-\n| 1\n|}\n따뜻."
    assert value(X.lead_from_content(L(content))) == "lead x"
    assert value(X.clean_section_text(X.section_content(L(content), X.KR_GEOGRAPHY_HEADINGS))) == "산과 강.\n\n둘째 셋째"
    table = value(X.climate_table(None, L(content)))
    assert table == {"caption": "표 1", "wikitext": "{|\n|+ 표 <b>1</b>\n|-\n| 1\n|}", "content": "따뜻."}
    only_text = value(X.climate_table(None, L("== Climate ==\nwarm")))
    assert only_text == {"caption": "Climate", "wikitext": "", "content": "warm"}
    assert value(X.climate_table(None, L("== x ==\n{|\n|+ 기후 값\n|}")))["caption"] == "기후 값"
    assert value(X.climate_table(None, L("nothing"))) is None
    assert value(X.climate_status(X.manual_climate_table()), X.climate_status(L(None).cast("map<string,string>"))) == ("needs_review", "missing")
    assert value(X.display_title(L("철원군 (대한민국)")), X.display_title(L("港区 (도쿄도)"), X.JP_TITLE_SUFFIXES)) == ("철원군", "港区")
    assert value(X.lead_paragraphs(L("a  b\n \n\n c\nd "))) == "a b\n\nc d"


def test_titles_and_regions(value):
    links = F.expr("array(struct('en' AS lang, 'File:x' AS title), struct('en' AS lang, '東京' AS title), struct('en' AS lang, 'Tokyo' AS title))")
    assert value(X.linked_title(links, "en"), X.linked_title(links, "ja")) == ("Tokyo", "")
    regions = province_regions()
    found = [X.detect_region(L(t), regions) for t in ("이 곳은 강원특별자치도 춘천시입니다.", "Located in Gyeongsangbuk-do area.", "seoul and Busan", "Seoulite", "관련 없는")]
    assert value(*found) == ("KR-42", "KR-47", "KR-11", None, None)
    assert value(X.detect_region(L("東京都 and Osaka"), prefecture_regions()), tokyo_korean_name(L("港区 (東京都)")), tokyo_korean_name(L("x"))) == ("JP-13", "미나토구", "")


def test_error_categories(value):
    texts = ("API timeout", "Connection timeout", "cannot decode body", "strange", "HTTP 503")
    assert value(*[X.error_category(L(t)) for t in texts]) == ("api", "network", "parsing", "other", "api")


def test_strict_dates(value):
    cases = {"20251001": "2025-10-01", "2025-1-5": "2025-01-05", "2025.12.31": "2025-12-31", "2025101": "2025-10-01", "20250230": "", "x": "", "": "", "2025-10.01": ""}
    assert value(*[D.strict_iso_date(L(t)) for t in cases]) == tuple(cases.values())


def test_structural_dates_and_keys(value):
    cases = {"20251399": "2025-13-99", " 2025-10-01 ": "2025-10-01", "2025.10.01": "", "2025": ""}
    assert value(*[D.structural_iso_date(L(t)) for t in cases]) == tuple(cases.values())
    keys = [D.festival_sort_key(L("7"), L(t)) for t in ("2025-10-01", "", None, "2025-xx-01")]
    assert value(*keys) == ("FESTIVAL#10#7", "FESTIVAL#00#7", "FESTIVAL#00#7", "FESTIVAL#00#7")
    assert value(D.date_range_text(L("a"), L("")), D.date_range_text(L(""), L("b")), D.date_range_text(L("a"), L("b"))) == ("a", "b", "a~b")


def test_visit_months(value):
    span = [D.visit_months_span(L(a), L(b)) for a, b in (("2026-01-31", "2026-03-02"), ("2025-11-01", "2027-01-01"), ("2026-03-20", "2026-03-05"), ("2026-05-01", "2026-03-05"))]
    assert value(*span) == ([1, 2, 3], list(range(1, 13)), [3], [])
    cyclic = [D.visit_months_cyclic(L(a), L(b)) for a, b in (("2025-11-01", "2026-02-01"), ("2025-03-01", ""), ("", "2025-01-01"), ("2025-04-01", "2030-06-01"), ("2025-13-99", "2025-02-01"))]
    assert value(*cyclic) == ([11, 12, 1, 2], [3], [], [4, 5, 6], [1, 2])


def test_months_and_seasons(value):
    assert value(*[D.stat_month(L(t)) for t in ("2025-01", "202501", "2025", "")]) == ("202501", "202501", "", "")
    assert value(*[D.strict_stat_month(L(t)) for t in ("2025-01", "20251", "2025-1")]) == ("202501", "202501", "")
    assert value(D.season(L(13)), D.calendar_season(L(13)), D.season(L(1))) == ("autumn", "unknown", "winter")
    assert value(D.days_in_month(L(2024), L(2)), D.days_in_month(L(1900), L(2))) == (29, 28)
    grid = value(D.month_grid("2025"))
    assert len(grid) == 12 and grid[1]["end_ymd"] == "20250228" and grid[0]["month"] == "2025-01"


def test_romanize(value):
    cases = {
        "고석정": "Goseokjeong", "직탕폭포": "Jiktangpokpo", "철원": "Cheorwon",
        "고석정 (한탄강 유네스코 세계지질공원)": "Goseokjeong", "도피안사(철원)": "Dopiansa",
        "DMZ 두루미 평화타운(구 철새마을)": "DMZDurumiPyeonghwataun", "제2땅굴(철원)": "Je2ttanggul", "": "", "()": "",
    }
    assert value(*[romanize(L(t)) for t in cases]) == tuple(cases.values())


def test_slugs(value):
    digest = hashlib.sha1("도시".encode()).hexdigest()[:8].upper()
    assert value(name_slug(L("Ōsaka shi")), name_slug(L("도시")), ascii_fold(L("Étaß"))) == ("OSAKA-SHI", f"KO-{digest}", "Eta")
    assert value(city_id(L("KR-42"), L("GANGNEUNG"), L("강릉시")), city_id(L(None).cast("string"), L(""), L(""))) == ("KR-42-GANGNEUNG", "KR-UNKNOWN-UNKNOWN")


def test_round_cents_equals_python(spark):
    random.seed(3)
    values = [random.randrange(10**7) / 100 / random.choice([28, 29, 30, 31]) for _ in range(3000)]
    values += [random.randrange(10**7) / 1000 for _ in range(3000)] + [2.675, 0.125, 0.375, 1e-9, 0.0, -2.675, -0.125, 18317.225, 5302.185]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_cents("v").alias("r")).collect()
    assert [r["r"] for r in rows] == [round(r["v"], 2) for r in rows]


def test_input_hashes(spark):
    item = {"title": "물빛 등대", "theme": "A b", "theme_tags": ["X y", "z"], "description": "d\te", "address": None}
    df = spark.createDataFrame([tuple(item.values())], "title string, theme string, theme_tags array<string>, description string, address string")
    text = "".join("".join(p.split()).lower() for p in ("", "d\te", "A b", json.dumps(["X y", "z"]), "물빛 등대"))
    assert df.select(attraction_input_hash(df.schema)).first()[0] == "sha256:" + hashlib.sha256(text.encode()).hexdigest()
    fest = spark.createDataFrame([("1", "a\tb C", ["p q", "r"])], "content_id string, description string, program array<string>")
    expected = "sha256:" + hashlib.sha256("1a\tbcpqr".encode()).hexdigest()
    assert fest.select(festival_input_hash(fest.schema)).first()[0] == expected


def test_payload_signature_ignores_key_order(value):
    a, b = (payload_signature(F.parse_json(L(t))) for t in ('{"a": 1, "b": [2]}', '{"b":[2],"a":1}'))
    assert value(a == b)
