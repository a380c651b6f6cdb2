"""Fixed dimension tables.

Fixed values: official codes and names, stated as they are published.
"""

from __future__ import annotations

# Korean provinces: id, Korean name, English name, region.
PROVINCES = (
    ("KR-11", "서울특별시", "Seoul", "Capital"),
    ("KR-26", "부산광역시", "Busan", "Yeongnam"),
    ("KR-27", "대구광역시", "Daegu", "Yeongnam"),
    ("KR-28", "인천광역시", "Incheon", "Capital"),
    ("KR-29", "광주광역시", "Gwangju", "Honam"),
    ("KR-30", "대전광역시", "Daejeon", "Chungcheong"),
    ("KR-31", "울산광역시", "Ulsan", "Yeongnam"),
    ("KR-36", "세종특별자치시", "Sejong", "Chungcheong"),
    ("KR-41", "경기도", "Gyeonggi-do", "Capital"),
    ("KR-42", "강원특별자치도", "Gangwon State", "Gangwon"),
    ("KR-43", "충청북도", "Chungcheongbuk-do", "Chungcheong"),
    ("KR-44", "충청남도", "Chungcheongnam-do", "Chungcheong"),
    ("KR-45", "전북특별자치도", "Jeonbuk State", "Honam"),
    ("KR-46", "전라남도", "Jeollanam-do", "Honam"),
    ("KR-47", "경상북도", "Gyeongsangbuk-do", "Yeongnam"),
    ("KR-48", "경상남도", "Gyeongsangnam-do", "Yeongnam"),
    ("KR-50", "제주특별자치도", "Jeju", "Jeju"),
)

# Japanese prefectures: id, Korean, Japanese and English name, region.
PREFECTURES = (
    ("JP-01", "홋카이도", "北海道", "Hokkaido", "Hokkaido"),
    ("JP-02", "아오모리현", "青森県", "Aomori", "Tohoku"),
    ("JP-03", "이와테현", "岩手県", "Iwate", "Tohoku"),
    ("JP-04", "미야기현", "宮城県", "Miyagi", "Tohoku"),
    ("JP-05", "아키타현", "秋田県", "Akita", "Tohoku"),
    ("JP-06", "야마가타현", "山形県", "Yamagata", "Tohoku"),
    ("JP-07", "후쿠시마현", "福島県", "Fukushima", "Tohoku"),
    ("JP-08", "이바라키현", "茨城県", "Ibaraki", "Kanto"),
    ("JP-09", "도치기현", "栃木県", "Tochigi", "Kanto"),
    ("JP-10", "군마현", "群馬県", "Gunma", "Kanto"),
    ("JP-11", "사이타마현", "埼玉県", "Saitama", "Kanto"),
    ("JP-12", "지바현", "千葉県", "Chiba", "Kanto"),
    ("JP-13", "도쿄도", "東京都", "Tokyo", "Kanto"),
    ("JP-14", "가나가와현", "神奈川県", "Kanagawa", "Kanto"),
    ("JP-15", "니가타현", "新潟県", "Niigata", "Chubu"),
    ("JP-16", "도야마현", "富山県", "Toyama", "Chubu"),
    ("JP-17", "이시카와현", "石川県", "Ishikawa", "Chubu"),
    ("JP-18", "후쿠이현", "福井県", "Fukui", "Chubu"),
    ("JP-19", "야마나시현", "山梨県", "Yamanashi", "Chubu"),
    ("JP-20", "나가노현", "長野県", "Nagano", "Chubu"),
    ("JP-21", "기후현", "岐阜県", "Gifu", "Chubu"),
    ("JP-22", "시즈오카현", "静岡県", "Shizuoka", "Chubu"),
    ("JP-23", "아이치현", "愛知県", "Aichi", "Chubu"),
    ("JP-24", "미에현", "三重県", "Mie", "Kansai"),
    ("JP-25", "시가현", "滋賀県", "Shiga", "Kansai"),
    ("JP-26", "교토부", "京都府", "Kyoto", "Kansai"),
    ("JP-27", "오사카부", "大阪府", "Osaka", "Kansai"),
    ("JP-28", "효고현", "兵庫県", "Hyogo", "Kansai"),
    ("JP-29", "나라현", "奈良県", "Nara", "Kansai"),
    ("JP-30", "와카야마현", "和歌山県", "Wakayama", "Kansai"),
    ("JP-31", "돗토리현", "鳥取県", "Tottori", "Chugoku"),
    ("JP-32", "시마네현", "島根県", "Shimane", "Chugoku"),
    ("JP-33", "오카야마현", "岡山県", "Okayama", "Chugoku"),
    ("JP-34", "히로시마현", "広島県", "Hiroshima", "Chugoku"),
    ("JP-35", "야마구치현", "山口県", "Yamaguchi", "Chugoku"),
    ("JP-36", "도쿠시마현", "徳島県", "Tokushima", "Shikoku"),
    ("JP-37", "가가와현", "香川県", "Kagawa", "Shikoku"),
    ("JP-38", "에히메현", "愛媛県", "Ehime", "Shikoku"),
    ("JP-39", "고치현", "高知県", "Kochi", "Shikoku"),
    ("JP-40", "후쿠오카현", "福岡県", "Fukuoka", "Kyushu"),
    ("JP-41", "사가현", "佐賀県", "Saga", "Kyushu"),
    ("JP-42", "나가사키현", "長崎県", "Nagasaki", "Kyushu"),
    ("JP-43", "구마모토현", "熊本県", "Kumamoto", "Kyushu"),
    ("JP-44", "오이타현", "大分県", "Oita", "Kyushu"),
    ("JP-45", "미야자키현", "宮崎県", "Miyazaki", "Kyushu"),
    ("JP-46", "가고시마현", "鹿児島県", "Kagoshima", "Kyushu"),
    ("JP-47", "오키나와현", "沖縄県", "Okinawa", "Kyushu"),
)

# Municipalities of Tokyo: Japanese title, Korean name.
TOKYO_MUNICIPALITIES = (
    ("千代田区", "지요다구"),
    ("中央区 (東京都)", "주오구"),
    ("港区 (東京都)", "미나토구"),
    ("新宿区", "신주쿠구"),
    ("文京区", "분쿄구"),
    ("台東区", "다이토구"),
    ("墨田区", "스미다구"),
    ("江東区", "고토구"),
    ("品川区", "시나가와구"),
    ("目黒区", "메구로구"),
    ("大田区", "오타구"),
    ("世田谷区", "세타가야구"),
    ("渋谷区", "시부야구"),
    ("中野区", "나카노구"),
    ("杉並区", "스기나미구"),
    ("豊島区", "도시마구"),
    ("北区 (東京都)", "기타구"),
    ("荒川区", "아라카와구"),
    ("板橋区", "이타바시구"),
    ("練馬区", "네리마구"),
    ("足立区", "아다치구"),
    ("葛飾区", "가쓰시카구"),
    ("江戸川区", "에도가와구"),
    ("八王子市", "하치오지시"),
    ("立川市", "다치카와시"),
    ("武蔵野市", "무사시노시"),
    ("三鷹市", "미타카시"),
    ("青梅市", "오메시"),
    ("府中市 (東京都)", "후추시"),
    ("昭島市", "아키시마시"),
    ("調布市", "조후시"),
    ("町田市", "마치다시"),
    ("小金井市", "고가네이시"),
    ("小平市", "고다이라시"),
    ("日野市", "히노시"),
    ("東村山市", "히가시무라야마시"),
    ("国分寺市", "고쿠분지시"),
    ("国立市", "구니타치시"),
    ("福生市", "훗사시"),
    ("狛江市", "고마에시"),
    ("東大和市", "히가시야마토시"),
    ("清瀬市", "기요세시"),
    ("東久留米市", "히가시쿠루메시"),
    ("武蔵村山市", "무사시무라야마시"),
    ("多摩市", "다마시"),
    ("稲城市", "이나기시"),
    ("羽村市", "하무라시"),
    ("あきる野市", "아키루노시"),
    ("西東京市", "니시토쿄시"),
    ("瑞穂町", "미즈호정"),
    ("日の出町", "히노데정"),
    ("檜原村", "히노하라촌"),
    ("奥多摩町", "오쿠타마정"),
    ("大島町", "오시마정"),
    ("利島村", "도시마촌"),
    ("新島村", "니지마촌"),
    ("神津島村", "고즈시마촌"),
    ("三宅村", "미야케촌"),
    ("御蔵島村", "미쿠라지마촌"),
    ("八丈町", "하치조정"),
    ("青ヶ島村", "아오가시마촌"),
    ("小笠原村", "오가사와라촌"),
)

CLASSIFICATION_VERSION = "2026-06-23"
# Tourism classification: code, name, entity type, theme.
CLASSIFICATION = (
    ("NA010100", "산", "Attraction", "자연·트레킹"),
    ("NA010200", "하천, 호수", "Attraction", "자연·트레킹"),
    ("NA010300", "섬", "Attraction", "자연·트레킹"),
    ("NA010400", "계곡, 폭포", "Attraction", "자연·트레킹"),
    ("NA020100", "국립공원", "Attraction", "자연·트레킹"),
    ("NA020200", "도립공원", "Attraction", "자연·트레킹"),
    ("NA020300", "군립공원", "Attraction", "자연·트레킹"),
    ("NA020400", "산림욕장", "Attraction", "자연·트레킹"),
    ("NA020700", "해수욕장", "Attraction", "바다·해안"),
    ("NA020800", "해안절경", "Attraction", "바다·해안"),
    ("NA020900", "등대, 포구, 항구", "Attraction", "바다·해안"),
    ("NA030100", "수목원", "Attraction", "자연·트레킹"),
    ("NA030200", "식물원", "Attraction", "자연·트레킹"),
    ("NA030300", "자연생태관", "Attraction", "자연·트레킹"),
    ("NA030400", "자연휴양림", "Attraction", "자연·트레킹"),
    ("NA030500", "동물원, 아쿠아리움", "Attraction", "자연·트레킹"),
    ("NA040100", "온천, 스파", "Attraction", "온천·휴양"),
    ("NA040200", "찜질방, 사우나", "Attraction", "온천·휴양"),
    ("NA040300", "헬스, 뷰티", "Attraction", "온천·휴양"),
    ("NA040400", "놀이공원, 워터파크", "Attraction", "자연·트레킹"),
    ("NA040500", "공원, 산책로", "Attraction", "자연·트레킹"),
    ("NA040600", "리조트, 펜션, 캠핑", "Attraction", "온천·휴양"),
    ("NA040700", "관광농원, 체험마을", "Attraction", "자연·트레킹"),
    ("NA050100", "둘레길, 트레킹코스", "Attraction", "자연·트레킹"),
    ("HS010100", "고궁", "Attraction", "역사·전통"),
    ("HS010200", "성곽, 성터", "Attraction", "역사·전통"),
    ("HS010300", "정자, 누각", "Attraction", "역사·전통"),
    ("HS010400", "사찰, 암자", "Attraction", "역사·전통"),
    ("HS010500", "서원, 향교", "Attraction", "역사·전통"),
    ("HS010600", "종교시설", "Attraction", "역사·전통"),
    ("HS010700", "한옥마을", "Attraction", "역사·전통"),
    ("HS010800", "전통마을, 민속촌", "Attraction", "역사·전통"),
    ("HS010900", "유적지, 사적", "Attraction", "역사·전통"),
    ("HS011000", "분묘, 왕릉", "Attraction", "역사·전통"),
    ("HS011100", "탑, 비석", "Attraction", "역사·전통"),
    ("HS011200", "기념관, 전시관", "Attraction", "역사·전통"),
    ("HS020100", "박물관", "Attraction", "역사·전통"),
    ("HS020300", "미술관, 화랑", "Attraction", "예술·감성"),
    ("HS020400", "문화원, 문화의집", "Attraction", "예술·감성"),
    ("HS030100", "전통시장", "Attraction", "역사·전통"),
    ("HS030200", "상점가, 거리", "Attraction", "역사·전통"),
    ("HS040100", "이색거리, 테마거리", "Attraction", "역사·전통"),
    ("HS040200", "벽화마을, 예술촌", "Attraction", "예술·감성"),
    ("VE010100", "미술관, 갤러리", "Attraction", "예술·감성"),
    ("VE010200", "공연장, 극장", "Attraction", "예술·감성"),
    ("VE010300", "영화관, 영상관", "Attraction", "예술·감성"),
    ("VE010400", "디자인전시관", "Attraction", "예술·감성"),
    ("VE010500", "박람회, 전시회장", "Attraction", "예술·감성"),
    ("VE010600", "공방, 체험관", "Attraction", "예술·감성"),
    ("VE010700", "카페, 북카페", "Attraction", "예술·감성"),
    ("VE010800", "해양체험", "Attraction", "바다·해안"),
    ("VE010900", "문화예술단지", "Attraction", "예술·감성"),
    ("VE020500", "레저스포츠", "Attraction", "예술·감성"),
    ("VE030100", "생태체험", "Attraction", "자연·트레킹"),
    ("VE040300", "녹색관광", "Attraction", "자연·트레킹"),
    ("VE070100", "역사체험", "Attraction", "역사·전통"),
    ("VE070600", "전통문화체험", "Attraction", "예술·감성"),
    ("FD010100", "음식점", "Restaurant", "미식·노포"),
    ("EV010100", "문화관광축제", "Festival", "예술·감성"),
    ("EV010200", "일반축제", "Festival", "역사·전통"),
    ("EV010300", "전통민속축제", "Festival", "역사·전통"),
    ("EV010400", "지역특산물축제", "Festival", "미식·노포"),
    ("EV010500", "자연생태축제", "Festival", "자연·트레킹"),
    ("EV010600", "기타행사", "Festival", "예술·감성"),
)
