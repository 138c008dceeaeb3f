"""Rule vocabularies and weights.

The default values are fixed values: the results depend on each word, weight and order, so they
are stated plainly and in their natural order.  Every operator takes a vocabulary as a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: venue classification -------------------------------------------------------

CATEGORY_EXACT = {
    "문화,예술>미술관": ("yes", 95, "미술관 카테고리"),
    "문화,예술>갤러리,화랑": ("yes", 93, "갤러리/화랑 카테고리"),
}
CATEGORY_MAYBE = {
    "문화,예술>전시관": 76,
    "문화,예술>복합문화공간": 67,
    "문화,예술>박람회,전시회": 62,
    "여행,명소>박물관": 60,
    "문화,예술>문화원": 55,
    "갤러리카페": 55,
}
CATEGORY_EXCLUDED = (
    "광고,마케팅>옥외,전시광고", "지원,대행>전시,행사대행", "지원,대행>이벤트,파티", "자동차>전시,판매", "쇼핑,유통>자동차", "학원.*미술교육", "교육,학문>문화센터", "교육원,교육센터>문화센터",
    "음식점>", "미용>", "생활,편의>꽃집", "도로시설>", "건설업>", "장소대여>", "쇼핑,유통>휴대폰", "쇼핑,유통>열쇠", "제조업>",
)
TITLE_STRONG = ("미술관", "아트센터", "아트뮤지엄", "아트스페이스", "갤러리", "화랑", "사진미술관", "사진전시", "전시공간", "전시장", r"\bart\b", r"\bgallery\b", r"\bmuseum\b")
TEXT_WEAK = ("문화공간", "문화예술", "복합문화", "박물관", "전시", "사진", "현대미술", "공예")
TITLE_NEGATIVE = ("주차장", "미술학원", "미술교육", "자동차", "분양전시관", "모델하우스", "홍보관", "전시광고", "행사대행", "렌탈", "카페", "식당", "다이닝", "공방", "꽃집", "인테리어")
PAGE_KEYWORDS = ("미술관", "갤러리", "화랑", "전시", "작가", "회화", "사진전", "현대미술", "아트센터", "art museum", "gallery", "exhibition", "artist", "photography")
VENUE_TYPES = (
    ("art_museum", ("미술관", "art museum")),
    ("gallery", ("갤러리", "화랑", "gallery")),
    ("photo_space", ("사진", "photography")),
    ("art_center", ("아트센터", "art center")),
    ("exhibition_hall", ("전시관", "전시장", "exhibition")),
    ("museum", ("박물관", "museum")),
    ("culture_space", ("복합문화", "문화공간", "문화원")),
)
REASON_MAYBE, REASON_STRONG, REASON_WEAK = "관련 가능 카테고리: ", "강한 예술 키워드: ", "약한 예술 키워드: "
REASON_EXCLUDED, REASON_NEGATIVE, REASON_NONE = "제외 카테고리: ", "제외성 제목 키워드: ", "예술 전시 관련 근거 부족"

# --- Fixed values: kinds of URL ---------------------------------------------------------------

HOST_TYPES = {
    "instagram.com": "social", "www.instagram.com": "social", "facebook.com": "social", "www.facebook.com": "social", "blog.naver.com": "blog", "m.blog.naver.com": "blog",
    "post.naver.com": "blog", "smartstore.naver.com": "store", "booking.naver.com": "booking", "map.naver.com": "naver_place", "place.map.kakao.com": "kakao_place",
}
SHORTLINK_HOSTS = ("litt.ly", "bit.ly", "linktr.ee", "url.kr", "naver.me", "me2.kr")
LOW_TRUST_TYPES = ("social", "blog", "store", "shortlink", "booking", "naver_place", "kakao_place")
DETAIL_KEYS = ("id", "idx", "seq", "no", "num", "wr_id", "exno", "ex_no", "exhibitionid", "articleid", "postid", "boardseq")
DETAIL_SEGMENTS = ("detail", "view", "read", "view.do", "detail.do", "read.do")

# --- Fixed values: list-page candidates -------------------------------------------------------

PRIMARY = (
    "전시", "전시안내", "전시정보", "현재전시", "예정전시", "진행전시", "지난전시", "상설전시", "특별전시", "기획전시", "exhibition", "exhibitions", "exhibit", "current exhibition",
    "upcoming exhibition", "past exhibition", "ongoing exhibition", "show", "shows", "what's on", "whats on", "whatson",
)
SECONDARY = ("공지", "공지사항", "새소식", "소식", "뉴스", "프로그램", "행사", "일정", "캘린더", "문화행사", "notice", "notices", "news", "program", "programs", "event", "events", "calendar", "schedule")
UPCOMING = ("예정", "예고", "upcoming", "coming", "future")
CURRENT = ("현재", "진행", "ongoing", "current", "now")
PAST = ("지난", "종료", "과거", "archive", "archives", "past", "closed")
NEGATIVE = (
    "대관", "공간대여", "예약", "예매", "채용", "로그인", "회원", "오시는길", "주차", "카페", "스토어", "상품", "교육", "강좌", "수업", "모집", "공모",
    "rent", "rental", "reservation", "booking", "login", "member", "recruit", "career", "shop", "store", "cafe", "education", "class",
)
LIKELY_PATHS = (
    "/exhibition", "/exhibitions", "/exhibit", "/exhibits", "/ex", "/display", "/show", "/shows", "/whatson", "/whats-on", "/whats_on", "/program", "/programs", "/event",
    "/events", "/notice", "/notices", "/news", "/board", "/bbs", "/calendar", "/schedule", "/ko/exhibition", "/kr/exhibition", "/kor/exhibition", "/html/exhibition", "/sub/exhibition", "/contents/exhibition",
)
PATH_HINTS = (
    ("/exhibition", 55, "url_path=exhibition"),
    ("/exhibitions", 55, "url_path=exhibitions"),
    ("/exhibit", 50, "url_path=exhibit"),
    ("/display", 42, "url_path=display"),
    ("/show", 38, "url_path=show"),
    ("what[s-]?on", 44, "url_path=whatson"),
    ("bo_table=(ex|exhibition|exhibit|gallery)", 58, "board_param=exhibition"),
    ("bbs.*(ex|exhibition|exhibit|gallery)", 45, "bbs_path=exhibition"),
    ("board.*(ex|exhibition|exhibit|gallery)", 45, "board_path=exhibition"),
    ("program", 28, "url_path=program"),
    ("notice", 25, "url_path=notice"),
    ("news", 22, "url_path=news"),
    ("calendar|schedule", 22, "url_path=schedule"),
)
SOURCE_POINTS = (("homepage_nav", 16), ("homepage_link", 8), ("sitemap", 10), ("naver_site_search", 18), ("common_path", 2), ("inferred_list_path", 18))
NOTICE_WORDS, NEWS_WORDS, PROGRAM_WORDS = ("공지", "공지사항", "notice", "notices"), ("소식", "뉴스", "news"), ("프로그램", "행사", "program", "event")

# --- Fixed values: events on pages ------------------------------------------------------------

BLOCK_TAGS = ("article", "aside", "dd", "div", "dl", "dt", "figcaption", "figure", "footer", "header", "li", "main", "nav", "ol", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
LINE_BREAK_TAGS = (
    "br", "p", "li", "tr", "div", "section", "article", "aside", "dd", "dl", "dt", "figcaption", "figure", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol",
    "table", "tbody", "td", "tfoot", "th", "thead", "ul",
)
#: Tags whose text is a heading, tags whose text is not shown, and the meta names that a summary reads.
HEADING_TAGS, SILENT_TAGS, META_NAMES = ("h1", "h2", "h3"), ("script", "style", "noscript"), ("description", "keywords", "og:title", "og:description")
#: Tags that name a menu by themselves, the attributes that may name one, the pattern of a menu's name, and its label.
MENU_TAGS, MENU_ATTRIBUTES, MENU_NAME, MENU_LABEL = ("header", "nav"), ("id", "class", "role"), r"\b(nav|gnb|lnb|menu|header|sitemap)\b", "nav_like"
EVENT_EXCLUDED = (
    "채용", "채용공고", "공고", "공지", "공지사항", "알림", "합격자", "서류심사", "면접", "모집", "지원", "접수", "일자리", "인턴", "오픈콜", "공모", "대관", "휴관", "휴무", "보도자료", "언론", "FAQ",
    "문의", "교육", "강연", "세미나", "워크숍", "포럼", "토크", "상영", "공연", "콘서트", "컨퍼런스", "대회", "recruit", "job", "application", "press", "notice",
)
EVENT_STRONG = (
    "전시회", "개인전", "기획전", "기획전시", "특별전", "특별전시", "초대전", "그룹전", "단체전", "상설전", "회고전", "소장품전", "아카이브전", "프로젝트전", "국제전", "온라인전", "아트페어", "비엔날레",
    "트리엔날레", "사진전", "조각전", "회화전", "드로잉전", "판화전", "공예전", "도예전", "디자인전", "건축전", "영상전", "미디어아트", "일러스트전", "졸업전시", "학위청구", "오픈스튜디오", "레지던시",
)
EVENT_HINTS = ("전시", "전람", "exhibition", "exhibit", "expo", "show", "showcase", "gallery", "museum", "art", "fair", "biennale", "triennale", "아트", "갤러리", "뮤지엄")
EVENT_WORD = "전시"
EVENT_GENERIC = (
    "전시", "전시회", "현재전시", "예정전시", "과거전시", "전시기간", "전시소개", "전시일정", "전시정보", "전시현황", "전시개요", "전시목록", "전시작품", "전시자료", "전시공간", "전시관", "전시장", "관람안내",
    "전시관람", "전시포스터", "전시사진", "전시장소", "전시안내",
)
LINK_GENERIC = (
    "상세", "상세보기", "자세히 보기", "자세히보기", "자세히", "더보기", "더 보기", "보기", "바로가기", "이동", "링크", "view", "detail", "details", "detail view", "more", "more info", "read more",
    "see more", "show more", "open",
)
QUOTES = ("《", "》", "‘", "’", "“", "”")
IMAGE_HINTS = ("poster", "flyer", "exhibition", "event", "schedule", "program", "notice", "banner", "전시", "전시회", "포스터", "일정", "행사", "공지", "안내")
IMAGE_POSTER = ("poster", "flyer", "전시", "포스터")
IMAGE_EXTENSION = r"(?i)\.(?:png|jpg|jpeg|webp|gif)(?:$|[?#])"
OCR_WORDS = ("전시", "개인전", "기획전", "특별전", "초대전", "그룹전")
DATE_RANGE = r"(?i)(\d{4}[./-]\d{1,2}[./-]\d{1,2})\s*(?:~|-|–|—|to)\s*(\d{4}[./-]\d{1,2}[./-]\d{1,2}|\d{1,2}[./-]\d{1,2})"
DATE_SINGLE = r"\d{4}[./-]\d{1,2}[./-]\d{1,2}"
#: (pattern, group that holds the place)
PLACES = (
    (r"(?iu)(?:주소|장소|전시장소|전시장|Location)\s*[:：]?\s*([^\n\r|]{5,120})", 1),
    (r"(?U)[가-힣]{2,}(?:특별시|광역시|도|시|군|구)[^\n\r|]{0,60}(?:로|길)\s*\d+[\w-]*", 0),
    (r"(?iU)\d+[^\n\r|]{0,80}(?:-ro|-gil|road|rd|street|st|avenue|ave|boulevard|blvd)[^\n\r|]{0,40}", 0),
)


@dataclass(frozen=True)
class VenueRules:
    """What venue classification is driven by; patterns are regular expressions without flags."""

    exact: dict = None
    maybe: dict = None
    excluded: tuple = CATEGORY_EXCLUDED
    strong: tuple = TITLE_STRONG
    weak: tuple = TEXT_WEAK
    negative: tuple = TITLE_NEGATIVE
    types: tuple = VENUE_TYPES

    def __post_init__(self) -> None:
        object.__setattr__(self, "exact", CATEGORY_EXACT if self.exact is None else self.exact)
        object.__setattr__(self, "maybe", CATEGORY_MAYBE if self.maybe is None else self.maybe)


@dataclass(frozen=True)
class CandidateRules:
    """What candidate scoring is driven by; keywords are lower-case substrings."""

    primary: tuple = PRIMARY
    secondary: tuple = SECONDARY
    upcoming: tuple = UPCOMING
    current: tuple = CURRENT
    past: tuple = PAST
    negative: tuple = NEGATIVE
    paths: tuple = PATH_HINTS
    sources: tuple = SOURCE_POINTS
    notice: tuple = NOTICE_WORDS
    news: tuple = NEWS_WORDS
    program: tuple = PROGRAM_WORDS


@dataclass(frozen=True)
class EventRules:
    """What event extraction is driven by."""

    excluded: tuple = EVENT_EXCLUDED
    strong: tuple = EVENT_STRONG
    hints: tuple = EVENT_HINTS
    word: str = EVENT_WORD
    generic: tuple = EVENT_GENERIC
    link_generic: tuple = LINK_GENERIC
    quotes: tuple = QUOTES
    image_hints: tuple = IMAGE_HINTS
    image_poster: tuple = IMAGE_POSTER
    ocr_words: tuple = OCR_WORDS
