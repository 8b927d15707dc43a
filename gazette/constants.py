"""Fixed values.

Every value in this module must equal the behaviour being reproduced for the
results to match (labels, formats, offsets, phrases). They are stated here
plainly and in their natural order; the operators take them as parameters so
callers can substitute their own.
"""

# --- fixed values: record model -------------------------------------------
SOURCES = ("jgrants", "nedo", "jst", "mext")          # allowed intake sources
TENDER_TYPES = ("commissioned", "subsidy", "unknown")  # type enum
CONFIRMED_TYPES = ("commissioned", "subsidy")          # values that win an upsert
UNKNOWN = "unknown"
URL_PREFIXES = ("http://", "https://")

# --- fixed values: scorer input sanitation ---------------------------------
SCORER_TITLE_CHARS = 300
SCORER_DESCRIPTION_CHARS = 800
SCORER_REASON_MAX_CHARS = 200
SCORE_MIN, SCORE_MAX = 0, 10
CONTROL_CHARS_CLASS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
# Prompt-injection phrases, matched case-insensitively anywhere in the text.
INJECTION_PHRASES = (
    "ignore (?:all )?previous instructions?",
    "forget (?:all )?previous",
    "disregard (?:all )?previous",
    "you are now",
    "act as",
    "system prompt:",
    "以前の指示を無視",
    "前の指示を全部忘れ",
    "前の指示を忘れ",
    "あなたは新しい",
    "システムプロンプト[：:]",
    "新しい役割",
    "これまでの指示を無視",
)
INJECTION_PLACEHOLDER = "[入力内容が不正なため除去されました]"
EMPTY_DESCRIPTION_PLACEHOLDER = "（概要なし）"

# --- fixed values: Japanese era calendar -----------------------------------
# Gregorian year = offset + era year.
ERA_OFFSETS = (("令和", 2018), ("平成", 1988), ("昭和", 1925))

# --- fixed values: page structure --------------------------------------------
# Definition-list labels: posted date = first dt with this text, deadline =
# last dt with this text.
POSTED_LABEL = "公告日"
DEADLINE_LABEL = "期限"
# Listing rows, and the href parts an anchor needs when a page has no rows.
CONTAINER_SELECTORS = "table.koubo-list tr, ul.koubo-list li, .koubo-item"
FALLBACK_HREF_PARTS = ("/koubo/", "/research/")

# --- fixed values: dates in listing rows -----------------------------------
ROW_DATE_PATTERN = r"\d{4}[/\-年]\d{1,2}[/\-月]\d{1,2}"

# --- fixed values: report labels -------------------------------------------
MONTH_LABEL_FORMAT = "yyyy年MM月"     # Java pattern for YYYY年MM月
MONTH_UNKNOWN_LABEL = "不明"
DATE_DASH = "—"
RUN_STAMP_FORMAT = "yyyy-MM-dd HH:mm 'UTC'"
BADGE_EXPIRED = "期限切れ"
BADGE_TODAY = "本日期限"
BADGE_DAYS_PREFIX = "あと "
BADGE_DAYS_SUFFIX = " 日"
BADGE_DATE_FORMAT = "MM/dd"
BADGE_DATE_SUFFIX = " まで"
BADGE_SOON_DAYS = 7
SCORE_BAND_HIGH, SCORE_BAND_MID = 8, 5
ACTIVE_MIN_SCORE = 5
EXCLUDED_FROM_BOARD_TYPE = "subsidy"

# --- fixed values: run defaults ---------------------------------------------
DEFAULT_MAX_RECORDS = 100
DEFAULT_UNION_LIMIT = 100
MIN_PER_KEYWORD = 10
UNCATEGORISED_SAMPLE_ROWS = 3
UNCATEGORISED_SAMPLE_CHARS = 80

# --- fixed values: dictionary layout ------------------------------------------
DICT_EXCLUDE_KEY = "exclude"
DICT_HINTS_KEY = "tender_type_hints"
