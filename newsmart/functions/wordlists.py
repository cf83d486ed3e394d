"""Published keyword lists.

The main finance list is longer than a source file should spell out, so it is a parameter: pass it
to :func:`published_lexicon` as one keyword per entry, in list order (see ``sources.tables.read_keywords``).
"""

from __future__ import annotations

from collections.abc import Sequence

from newsmart.functions.lexicon import LanguageLists, Lexicon

# ---- Fixed values: keyword lists, in list order ------------------------------------------------

COUNTRIES = {
    "KR": ["korea", "korean", "south korea", "seoul", "busan", "incheon", "korean won", " won ", "krw",
           "kospi", "kosdaq", "bank of korea", "bok", "financial services commission", "yoon suk", "lee jae"],
    "US": ["united states", " u.s.", "america", "american", "washington d.c.", "new york", "wall street",
           "us dollar", "usd", "federal reserve", "the fed", "jerome powell", "nasdaq", "s&p 500",
           "dow jones", "treasury secretary", "trump", "donald trump", "white house"],
    "CN": ["china", "chinese", "beijing", "shanghai", "guangzhou", "shenzhen", "yuan", "renminbi", "rmb",
           "cny", "people's bank of china", "pboc", "xi jinping", "li qiang", "cpc", "politburo"],
    "JP": ["japan", "japanese", "tokyo", "osaka", "kyoto", "japanese yen", "yen", "jpy", "bank of japan",
           "boj", "kazuo ueda", "nikkei", "topix", "kishida", "ishiba"],
    "ID": ["indonesia", "indonesian", "jakarta", "surabaya", "bandung", "indonesian rupiah", "rupiah", "idr",
           "bank indonesia", "ojk", "prabowo", "jokowi", "kb bukopin", "gojek", "tokopedia", "bukalapak"],
    "VN": ["vietnam", "vietnamese", "hanoi", "ho chi minh city", "hcmc", "vietnamese dong", "vnd",
           "state bank of vietnam", "sbv", "to lam", "nguyen", "vn-index", "vingroup", "vinfast", "hose"],
    "KH": ["cambodia", "cambodian", "phnom penh", "siem reap", "cambodian riel", "riel", "khr", "hun manet",
           "hun sen", "national bank of cambodia", "nbc cambodia", "prasac", "acleda", "aba bank",
           "wing money", "wing bank", "bakong", "amret", "hattha", "canadia bank",
           "cambodia development resource institute", "cdri", "garment sector", "garment industry"],
    "MM": ["myanmar", "burmese", "burma", "yangon", "naypyidaw", "mandalay", "myanmar kyat", "kyat", "mmk",
           "central bank of myanmar", "tatmadaw", "sac", "min aung hlaing", "aung san suu kyi", "nld", "nug",
           "kbz bank", "aya bank", "myanmar economic bank", "meb", "myanmar payment union", "mpu",
           "myanmar sanctions", "myanmar economy"],
    "IN": ["india", "indian", "new delhi", "mumbai", "bangalore", "bengaluru", "indian rupee", "rupee", "inr",
           "reserve bank of india", "rbi", "narendra modi", "sebi", "sensex", "nifty", "bse", "nse"],
    "GB": ["united kingdom", "britain", "british", "england", "london", "pound sterling", "sterling", "gbp",
           "bank of england", "boe", "ftse", "city of london", "downing street", "keir starmer"],
    "HK": ["hong kong", "hongkong", "hksar", "hong kong dollar", "hkd", "hang seng", "hkex", "hkma",
           "hong kong monetary authority", "john lee"],
    "SG": ["singapore", "singaporean", "singapore dollar", "sgd", "straits times index", "sgx",
           "monetary authority of singapore", "mas", "temasek", "gic", "lawrence wong"],
}

KOREAN_FINANCE = [
    "금리", "기준금리", "금리인상", "금리인하", "금리동결", "환율", "원달러", "달러",
    "인플레이션", "물가", "소비자물가", "생산자물가", "경제성장", "성장률", "경기", "경기침체", "경기둔화", "불황",
    "gdp", "국내총생산", "무역", "교역", "수출", "수입", "무역수지", "경상수지",
    "재정", "예산", "재정적자", "재정흑자", "국가채무", "국채", "적자", "흑자",
    "금융", "은행", "금융시장", "자본시장", "금융감독", "중앙은행", "기준금리",
    "대출", "여신", "수신", "부실대출", "주식", "증시", "주가", "코스피", "나스닥",
    "채권", "국채", "회사채", "외환", "외화", "달러화", "위안화", "엔화",
    "투자", "외국인투자", "직접투자", "fdi", "인수합병", "m&a", "기업인수",
    "상장", "ipo", "기업공개", "파산", "부도", "채무불이행", "구조조정",
    "관세", "제재", "무역협정", "fta", "공급망", "반도체", "배터리", "전기차",
    "imf", "세계은행", "아시아개발은행", "adb", "bis", "g20", "oecd",
    "통화정책", "재정정책", "경제정책", "규제", "esg", "탄소", "탄소중립", "넷제로",
    "유가", "원유", "에너지", "재생에너지", "태양광", "풍력",
]

KOREAN_COUNTRIES = {
    "US": ["미국", "미 연준", "연준", "연방준비제도", "트럼프", "바이든", "재무부"],
    "CN": ["중국", "위안화", "인민은행", "중국인민은행", "중국 경제"],
    "JP": ["일본", "엔화", "일본은행", "엔 ", "BOJ"],
    "IN": ["인도", "루피", "인도 경제", "인도중앙은행"],
    "ID": ["인도네시아", "루피아", "인도네시아 중앙은행"],
    "VN": ["베트남", "동화", "베트남 경제", "베트남 중앙은행"],
    "KH": ["캄보디아", "캄보디아 경제"],
    "MM": ["미얀마", "미얀마 경제"],
    "KR": ["한국", "한국은행", "기재부", "금융위", "코스피", "원화"],
    "GB": ["영국", "영란은행", "파운드", "런던"],
    "HK": ["홍콩", "홍콩달러", "항셍"],
    "SG": ["싱가포르", "싱가포르달러", "싱가포르 통화청"],
}

VIETNAMESE_FINANCE = [
    "ngân hàng", "ngân hàng nhà nước", "lãi suất", "tỷ giá", "lạm phát", "tăng trưởng", "gdp", "kinh tế",
    "tài chính", "đầu tư", "chứng khoán", "thị trường", "cổ phiếu", "trái phiếu", "xuất khẩu", "nhập khẩu",
    "thương mại", "ngân sách", "thuế", "doanh nghiệp", "vốn", "tín dụng", "nợ xấu", "lợi nhuận",
    "fdi", "đồng việt nam", "vnd", "sbv", "bidv", "vietcombank", "vietinbank", "agribank", "vpbank",
]

INDONESIAN_FINANCE = [
    "ekonomi", "keuangan", "moneter", "fiskal", "inflasi", "deflasi", "pertumbuhan", "resesi", "gdp", "pdb",
    "anggaran", "defisit", "surplus", "saham", "bursa", "ihsg", "obligasi", "investasi", "modal",
    "pasar modal", "dividen", "ipo", "emiten", "reksadana", "aset", "bank", "perbankan", "rupiah", "idr",
    "suku bunga", "kredit", "pinjaman", "bank indonesia", "ojk", "lkm", "bisnis", "perusahaan", "merger",
    "akuisisi", "ekspor", "impor", "perdagangan", "tarif", "sanksi", "subsidi", "privatisasi", "esg",
    "karbon", "energi", "keberlanjutan", "lingkungan", "tata kelola",
]

EXCLUSIONS = [
    "gold medal", "silver medal", "bronze medal", "powerlifter", "weightlift", "sea games", "asian games",
    "olympic", "world cup qualifier", "world cup match", "hat trick", "penalty shootout", "clean sheet",
    "sumo", "tennis match", "cricket match", "badminton match", "football match", "soccer match",
    "basketball game", "chess tournament", "chess championship",
    "box office", "music festival", "concert tour", "music album", "grammy award", "academy award",
    "film festival", "chart-topping", "chart topping", "movie review", "book review", "art exhibition",
    "dies at", "passed away", "in memoriam", "obituary", "saxophonist", "violinist", "pianist", "conductor",
    "deep-sea", "new species", "newly discovered species", "paleontolog", "fossil discover", "marine biolog",
    "food bank", "blood bank", "seed bank", "eye bank", "river bank", "bank erosion", "bank robbery",
    "bank heist", "bank holiday", "piggy bank", "memory bank",
    "investment in education", "investment in health", "investment in sport",
    "trade show", "trade fair", "trade expo", "trade union", "budget airline", "budget hotel", "budget travel",
    "ipl match", "ipl season", "ipl final", "ipl auction", "ipl trophy", "cricket tournament",
    "cricket series", "cricket board", "cricket team", "cricket stadium", "cricket score",
    "batting average", "bowling average", "t20 match", "t20 series", "test cricket", "one-day international",
    "sports betting", "betting odds", "bookmaker",
    "celebrity couple", "celebrity divorce", "box office hit", "music chart", "chart position",
    "streaming hit", "election rally", "campaign rally", "campaign trail",
    "earthquake hit", "flood victim", "cyclone hit", "typhoon hit", "wildfire", "volcanic eruption",
]

# ---- End of fixed values -----------------------------------------------------------------------


def _by_country(lists: dict[str, list[str]]) -> tuple[tuple[str, tuple[str, ...]], ...]:
    return tuple((country, tuple(keywords)) for country, keywords in lists.items())


def published_lexicon(finance: Sequence[str]) -> Lexicon:
    """Lexicon of the published lists around the given main finance list."""
    return Lexicon(
        finance=tuple(finance),
        countries=_by_country(COUNTRIES),
        exclusion=tuple(EXCLUSIONS),
        own={"ko": LanguageLists(tuple(KOREAN_FINANCE), _by_country(KOREAN_COUNTRIES))},
        extra={"id": tuple(INDONESIAN_FINANCE), "vi": tuple(VIETNAMESE_FINANCE)},
    )
