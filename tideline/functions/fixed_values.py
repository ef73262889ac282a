"""Fixed values.

These literals occur in the data the jobs read or write (column names, event
names, ids, patterns, limits). They must be equal for the results to be right,
so they are stated here, together, as plain text, and nowhere else.
"""

# --- feeds: (feed, countries, locales) -------------------------------------
FEEDS = [
    ("NEW_TAB_EN_US", ["US", "CA"], ["en-CA", "en-GB", "en-US"]),
    ("NEW_TAB_EN_GB", ["GB", "IE"], ["en-CA", "en-GB", "en-US"]),
    ("NEW_TAB_EN_INTL", ["IN"], ["en-CA", "en-GB", "en-US"]),
    ("NEW_TAB_DE_DE", ["DE", "CH", "AT", "BE"], ["de", "de-AT", "de-CH"]),
    ("NEW_TAB_IT_IT", ["IT"], ["it"]),
    ("NEW_TAB_FR_FR", ["FR"], ["fr"]),
    ("NEW_TAB_ES_ES", ["ES"], ["es-ES"]),
]

# --- telemetry --------------------------------------------------------------
RELEASE_CHANNEL = "release"
LAST_LEGACY_VERSION = 120
FIRST_NESTED_VERSION = 121
FLAG_SECTION = 4  # recommendations section switched on
FLAG_SPONSORED = 32  # sponsored items switched on
MAX_CLICKS_PER_SECOND = 3  # groups with this many clicks or more are spam
SPONSORED_TYPE = "spoc"
SPONSORED_POSITIONS = [1, 2, 4, 5, 7, 11, 18, 20]
EXCLUDED_PAGE = "https://start.example.com/newtab.html"
LEGACY_SAVE_COLUMN = "reader"
NESTED_CATEGORY = "reader"
NESTED_EVENT_NAMES = ["impression", "click", "save", "dismiss"]
NESTED_SECTION_FLAG = "reader_enabled"
NESTED_SPONSORED_FLAG = "reader_sponsored_stories_enabled"
SECTION_DISABLED_COUNT = "users_with_reader_disabled_count"
SPONSORED_DISABLED_COUNT = "users_with_spocs_disabled_count"
NESTED_SOURCE = "CARDGRID"

# --- trailing engagement ----------------------------------------------------
LEGACY_BUILD_BEFORE = "20231116134553"
NESTED_BUILD_FROM = "20231116134553"
LEGACY_SOURCES = ["TOP_STORIES", "CARDGRID"]
RECOMMENDATION_DAYS = 28
ENGAGEMENT_KEY = [
    "updated_at",
    "key",
    "recommendation_surface_id",
    "corpus_slate_configuration_id",
    "corpus_item_id",
]
TRAILING_COUNTERS = [
    "trailing_1_day_impressions",
    "trailing_1_day_opens",
    "trailing_7_day_impressions",
    "trailing_7_day_opens",
    "trailing_14_day_impressions",
    "trailing_14_day_opens",
    "trailing_21_day_impressions",
    "trailing_21_day_opens",
    "trailing_28_day_impressions",
    "trailing_28_day_opens",
]

# --- user impressions ---------------------------------------------------------
IMPRESSION_WINDOW_DAYS = 29
IMPRESSION_MAX_COUNT = 9
IMPRESSION_MAX_AGE_DAYS = 14

# --- publisher features -------------------------------------------------------
PUBLISHER_WINDOW_DAYS = 7
PUBLISHER_MIN_WORDS = 900
PUBLISHER_APPROVED_DAYS = 360
PUBLISHER_LANGUAGE = "en"
EXCLUDED_TOPIC = "CORONAVIRUS"
# (topic, name of its counter column after the prefix "num_approved_")
APPROVED_TOPICS = [
    ("BUSINESS", "business"),
    ("CAREER", "career"),
    ("EDUCATION", "education"),
    ("ENTERTAINMENT", "entertainment"),
    ("FOOD", "food"),
    ("GAMING", "gaming"),
    ("HEALTH_FITNESS", "health"),
    ("PARENTING", "parenting"),
    ("PERSONAL_FINANCE", "personal_finance"),
    ("POLITICS", "politics"),
    ("SCIENCE", "science"),
    ("SELF_IMPROVEMENT", "self_improvement"),
    ("TECHNOLOGY", "technology"),
    ("TRAVEL", "travel"),
    ("SPORTS", "sports"),
]

# --- backend events -----------------------------------------------------------
BACKEND_CONTEXTS = {
    "agent": "contexts_com_tracker_ua_parser_context_1",
    "app": "contexts_com_tracker_mobile_application_1",
    "api_user": "contexts_com_reader_api_user_1",
    "user": "contexts_com_reader_user_1",
    "ui": "contexts_com_reader_ui_1",
    "item_update": "unstruct_event_com_reader_list_item_update_1",
}
BACKEND_EVENT_CATEGORY = "event"
PAGE_PATHS = [
    "/explore%", "/__/explore%", "/__-__/explore%",
    "/collections%", "/__/collections%", "/__-__/collections%",
]
DEV_APP_PATTERN = "%-dev"
APP_PATTERN = "reader-%"

# --- candidate sets -----------------------------------------------------------
EXCLUDED_ITEM_ID = "00000000-0000-4000-8000-000000000001"
REVIEW_STATUS = "recommendation"
LOADED_MANUALLY = "MANUAL"
SURFACE_EN_US = "NEW_TAB_EN_US"
SURFACE_DE_DE = "NEW_TAB_DE_DE"
SURFACE_DAILY_HITS = "READER_HITS_EN_US"
DAILY_HITS_HOUR_UTC = 7
DAILY_HITS_COUNT = 8
TOPIC_MAX_AGE_DAYS = 90
LIFE_HACK_TOPICS = ["SELF_IMPROVEMENT", "CAREER", "HEALTH_FITNESS", "PERSONAL_FINANCE"]
# (id, name, kind, parameters)
STATIC_CANDIDATE_SETS = [
    ("00000000-0000-4000-8000-000000000002", "en_us/collections_by_recency", "collections_by_recency",
     {"language": "EN", "scheduled_surface_id": "NEW_TAB_EN_US", "max_age_days": -60}),
    ("00000000-0000-4000-8000-000000000003", "de_de/collections_by_recency_de_de", "collections_by_recency",
     {"language": "DE", "scheduled_surface_id": "NEW_TAB_DE_DE", "max_age_days": -60}),
    ("00000000-0000-4000-8000-000000000004", "en_us/life_hacks", "life_hacks",
     {"scheduled_surface_id": "NEW_TAB_EN_US", "max_age_days": 30}),
    ("00000000-0000-4000-8000-000000000005", "en_us/reader_hits", "daily_hits",
     {"scheduled_surface_id": "READER_HITS_EN_US"}),
    ("00000000-0000-4000-8000-000000000006", "en_us/new_tab_not_syndicated_or_collection", "scheduled_items",
     {"max_age_days": -3, "scheduled_surface_id": "NEW_TAB_EN_US"}),
    ("00000000-0000-4000-8000-000000000007", "de_de/new_tab_not_syndicated_or_collection", "scheduled_items",
     {"max_age_days": -3, "scheduled_surface_id": "NEW_TAB_DE_DE"}),
    ("00000000-0000-4000-8000-000000000008", "en_us/recommended_by_recency", "recommended_by_recency",
     {"n_per_topic": 6, "scheduled_surface_id": "NEW_TAB_EN_US"}),
]
MAY_BE_EMPTY = "coronavirus"  # sets with this in their name may have no items

# --- legacy candidate sets ----------------------------------------------------
FEED_ID_EN_US = 1
FEED_ID_DE_DE = 3
LONGREAD_MIN_WORDS = 4500
SHORTREAD_MAX_WORDS = 900
READS_LIMIT = 90
CURATED_FEED_DAYS = 7
CURATED_FEED_LIMIT = 300
SYNDICATED_DAYS = 9
SYNDICATED_LIMIT = 180
LEGACY_TOPIC_LIMIT = 45
LEGACY_REVIEW_DAYS = 90
LEGACY_LONGREADS = [
    {"candidate_set_id": "00000000-0000-4000-8000-000000000009", "language": "EN",
     "scheduled_surface_id": "NEW_TAB_EN_US", "feed_id": 1},
]
LEGACY_SHORTREADS = [
    {"candidate_set_id": "00000000-0000-4000-8000-000000000010", "language": "EN",
     "scheduled_surface_id": "NEW_TAB_EN_US", "feed_id": 1},
    {"candidate_set_id": "00000000-0000-4000-8000-000000000011", "language": "DE",
     "scheduled_surface_id": "NEW_TAB_DE_DE", "feed_id": 3},
]
LEGACY_CURATED_FEEDS = [
    {"candidate_set_id": "00000000-0000-4000-8000-000000000012", "scheduled_surface_id": "NEW_TAB_EN_US",
     "feed_id": 1, "collections_only": False, "not_syndicated": False},
    {"candidate_set_id": "00000000-0000-4000-8000-000000000013", "scheduled_surface_id": "NEW_TAB_EN_US",
     "feed_id": 1, "collections_only": False, "not_syndicated": True},
    {"candidate_set_id": "00000000-0000-4000-8000-000000000014", "scheduled_surface_id": "NEW_TAB_EN_US",
     "feed_id": 1, "collections_only": True, "not_syndicated": True},
    {"candidate_set_id": "00000000-0000-4000-8000-000000000015", "scheduled_surface_id": "NEW_TAB_DE_DE",
     "feed_id": 3, "collections_only": False, "not_syndicated": False},
]
LEGACY_SYNDICATED = [
    {"candidate_set_id": "00000000-0000-4000-8000-000000000016", "scheduled_surface_id": "NEW_TAB_EN_US"},
]
SYNDICATED_KEY = "reader_resolved_id"
MESSAGE_VERSION = 3
MESSAGE_EXPIRY_SECONDS = 86400 * 7 * 4

# --- user sync ------------------------------------------------------------------
ALIAS_LABEL = "email"
USER_LOCALE_COLUMN = "reader_locale"
NEW_ALIAS_FLAG_COLUMN = "is_new_email_alias_for_reader_user"
EVENT_NAME_COLUMN = "messaging_event_name"
SIGNUP_EVENT = "newsletter_signup"
DELETE_TRIGGER = "account_delete"
MASKED_DOMAIN = "@example.com"
EMAIL_PATTERN = r"^.+@.+\..+"
TRACK_LIMIT = 75
OTHER_LIMIT = 50
SUBSCRIPTION_GROUPS = {
    "production": {
        "READER_HITS_US_DAILY": "00000000-0000-4000-8000-000000000017",
        "READER_HITS_US_WEEKLY": "00000000-0000-4000-8000-000000000018",
        "READER_HITS_DE_DAILY": "00000000-0000-4000-8000-000000000019",
    },
    "development": {
        "READER_HITS_US_DAILY": "00000000-0000-4000-8000-000000000020",
        "READER_HITS_US_WEEKLY": "00000000-0000-4000-8000-000000000021",
        "READER_HITS_DE_DAILY": "00000000-0000-4000-8000-000000000022",
    },
}

# --- content score --------------------------------------------------------------
SCORE_MAX_SMALL_ID = 2147483647
SCORE_LOSS_MULTIPLE = 9
SCORE_WEIGHTS = {"open": 1, "favorite": 5, "share": 7}

# --- revenue ----------------------------------------------------------------------
REVENUE_PREFIX = "Current"
REVENUE_PREFIX_ARCHIVED = "Archived"
REVENUE_COLUMNS = [
    ("record_date", "date"), ("network", "string"), ("url", "string"),
    ("utm_campaign", "string"), ("utm_content", "string"), ("utm_medium", "string"),
    ("utm_source", "string"), ("utm_term", "string"), ("site_domain", "string"),
    ("ad_unit", "string"), ("size", "string"), ("country_code", "string"),
    ("device_type", "string"), ("device_os", "string"), ("browser", "string"),
    ("integration_partner", "string"), ("impressions", "bigint"),
    ("net_revenue", "bigint"), ("net_cpm", "double"),
]
REVENUE_DAYS_BACK = 14

# --- articles ---------------------------------------------------------------------
FILES_PER_TRIGGER = 50
ROWS_PER_FILE = 50000
# clean-up of extracted text, in this order: (pattern, replacement)
TEXT_RULES = [
    (r"#+\s+", ""),
    (r"-+\|[\-\|]+ *\n", ""),
    (r"\| ", "\n"),
    (r"\* \* \*\n\n", ""),
    (r"\s*?(\n{1,2})\s*", "$1"),
]

# --- curated feed exports: table -> (columns of the load, unix-time columns, local-time columns)
CURATED_FEEDS = {
    "curated_feed_items": (
        ["curated_rec_id", "feed_id", "resolved_id", "prospect_id", "queued_id", "status",
         "time_live", "time_added", "time_updated"],
        ["time_live", "time_added", "time_updated"], []),
    "curated_feed_items_deleted": (
        ["id", "curated_rec_id", "feed_id", "resolved_id", "prospect_id", "queued_id", "status",
         "time_live", "time_added", "time_updated", "deleted_user_id", "deleted_at"],
        ["time_live", "time_added", "time_updated"], ["deleted_at"]),
    "curated_feed_prospects": (
        ["prospect_id", "feed_id", "resolved_id", "type", "status", "curator", "time_added",
         "time_updated", "top_domain_id", "title", "excerpt", "image_src"],
        ["time_added", "time_updated"], []),
    "curated_feed_queued_items": (
        ["queued_id", "feed_id", "resolved_id", "prospect_id", "status", "curator",
         "relevance_length", "topic_id", "weight", "time_added", "time_updated"],
        ["time_added", "time_updated"], []),
    "tile_source": (
        ["tile_id", "source_id", "type", "created_at", "updated_at"],
        [], ["created_at", "updated_at"]),
}
LOADED_AT_COLUMN = "warehouse_loaded_at"

# --- staged-load lineage and offset state -------------------------------------------
LINEAGE_COLUMNS = [
    ("_gs_file_name", "string"), ("_gs_file_row_number", "bigint"), ("_gs_file_date", "string"),
    ("_gs_file_time", "string"), ("_loaded_at", "timestamp"),
]
OFFSET_COLUMNS = [
    ("sql_folder_name", "string"), ("created_at", "timestamp"),
    ("updated_at", "timestamp"), ("last_offset", "string"),
]
FOLDER_TIME_FORMAT = "HH-mm-ss-SSS"
