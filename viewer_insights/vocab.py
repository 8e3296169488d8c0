"""Vocabularies that define the semantics of the pipeline.

Everything in the block marked FIXED VALUES must equal the values the
original pipeline uses; changing any of them changes results.  The long
keyword-rule vocabulary (hundreds of phrases) is *not* shipped here: it is
data, supplied by the caller as a rule table (see ``functions.rules``).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline's results)
# ---------------------------------------------------------------------------

# Search-log timestamp text: Vietnamese AM/PM markers and their English form.
AMPM_MARKERS = {" CH": " PM", " SA": " AM"}

# Timestamp patterns tried in this order; the first successful parse wins.
# ``None`` is the final attempt with Spark's default timestamp cast rules.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss.SS",
    "yyyy-MM-dd HH:mm:ss.S",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd h:mm:ss.SSS a",
    "yyyy-MM-dd h:mm:ss.SS a",
    "yyyy-MM-dd h:mm:ss a",
    None,
)

# Junk month-B keywords: length <= 1, or a run of five or more digits.
JUNK_MIN_LENGTH = 2
JUNK_DIGITS_PATTERN = "^[0-9]{5,}$"

# Intent patterns scored against the month-B keyword (unanchored).
HIGH_INTENT_PATTERN = "(?i)(phim|tập|vietsub|thuyết minh|full|hd|review|trọn bộ|mới nhất|ss[0-9]+|mùa)"
GENRE_INTENT_PATTERN = "(?i)(hành động|kinh dị|ma|tình cảm|hoạt hình|anime|hài|chiếu rạp)"

# Score = (cnt_B * 1.5 + cnt_A * 1.0 + 50 if both months > 0) * multiplier
WEIGHT_MONTH_B = 1.5
WEIGHT_MONTH_A = 1.0
BOTH_MONTHS_BONUS = 50
MULTIPLIER_HIGH_INTENT = 3.0
MULTIPLIER_GENRE_INTENT = 2.0
MULTIPLIER_TITLE_LIKE = 1.5
MULTIPLIER_DEFAULT = 1.0
TITLE_MIN_WORDS = 2
TITLE_MAX_WORDS = 6

# Cohort sizes used by the original pipeline.
TOP_USERS_N = 5000
SAMPLE_USERS_N = 5000

# Rule category of a keyword that no rule matches.
UNMAPPED = "Unmapped"

# Category labels after the dictionary lookup.
OTHER = "Other"
NO_SEARCH = "No_Search"

# User status and preference-change labels.
NEW_USER = "New_User"
CHURNED_USER = "Churned_User"
RETAINED_USER = "Retained_User"
CHANGED = "changed"
UNCHANGED = "unchanged"
JOURNEY_ARROW = " -> "

# Viewing log: application code -> viewing category (case-sensitive codes).
APP_CATEGORY_MAP = {
    "CHANNEL": "Truyền Hình", "DSHD": "Truyền Hình", "KPLUS": "Truyền Hình", "KPlus": "Truyền Hình",
    "VOD": "Phim Truyện", "FIMS_RES": "Phim Truyện", "BHD_RES": "Phim Truyện", "VOD_RES": "Phim Truyện",
    "FIMS": "Phim Truyện", "BHD": "Phim Truyện", "DANET": "Phim Truyện",
    "RELAX": "Giải Trí",
    "CHILD": "Thiếu Nhi",
    "SPORT": "Thể Thao",
}
# Viewing categories in tie-break order (first wins for MostWatch).
VIEW_CATEGORIES = ("Truyền Hình", "Phim Truyện", "Giải Trí", "Thiếu Nhi", "Thể Thao")
# ASCII column suffix for each viewing category (serving-table names).
VIEW_CATEGORY_COLUMNS = {
    "Truyền Hình": "Truyen_Hinh",
    "Phim Truyện": "Phim_Truyen",
    "Giải Trí": "Giai_Tri",
    "Thiếu Nhi": "Thieu_Nhi",
    "Thể Thao": "The_Thao",
}
NO_VIEWING = "None"
MIXED = "Mixed"
TASTE_SEPARATOR = " - "
DAYS_PER_MONTH = 30
# Viewing-log file names carry the day: YYYYMMDD.json
VIEW_FILE_DATE_PATTERN = r"(\d{8})\.json$"
VIEW_FILE_DATE_FORMAT = "yyyyMMdd"
# A valid viewing-log account id starts with an ASCII letter or digit.
VALID_ACCOUNT_PATTERN = "^[a-zA-Z0-9]"

# VIP report defaults: Active threshold as written in the original query
# (Active is on a 0-100 scale, so 80 is the threshold that was meant).
VIP_MIN_ACTIVE = 0.8
VIP_TASTES = ("Phim Truyện", "Thể Thao")
VIP_K = 10
TOP_SHIFTS_K = 5

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------
