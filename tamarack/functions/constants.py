"""The feature contract and published formula constants."""

# Keywords behind the has_<keyword> flags, in column order.
KEYWORDS = [
    "spoiler", "reveals", "plot twist", "ending", "dies", "death", "killer",
    "murderer", "secret", "betrayal", "identity", "truth", "hidden", "unveiled",
    "climax", "finale", "conclusion", "resolution", "twist", "surprise",
    "unexpected", "shock", "disclosure", "unmask", "revelation", "expose",
    "uncover", "spoils", "giveaway", "leak", "spoiling", "foretell", "foreshadow",
]

# Entity types behind the entity_<TYPE> counts, in column order.
ENTITY_TYPES = ["PERSON", "ORGANIZATION", "GPE", "LOCATION", "FACILITY", "PRODUCT"]

# Text and identifier columns that are no model features.
NON_FEATURES = [
    "user_id", "is_spoiler", "review_text", "plot_summary", "plot_synopsis",
    "movie_id", "review_date", "release_date", "review_summary", "duration",
]

# Fixed values: (lower bound exclusive, upper bound inclusive, label) of the release-lag bins.
LAG_BINS = [
    (-1, 7, "First Week"),
    (7, 30, "First Month"),
    (30, 90, "1-3 Months"),
    (90, 180, "3-6 Months"),
    (180, 365, "6-12 Months"),
    (365, None, "Over a Year"),
]

# Day names in calendar order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Raw date layouts, tried in order.
DATE_FORMATS = ["yyyy-MM-dd", "d MMMM yyyy", "yyyy-MM", "yyyy"]

# The published VADER rule constants (Hutto & Gilbert, 2014).
VADER_ALPHA = 15.0
VADER_BOOST = 0.293
VADER_CAPS = 0.733
VADER_NEGATION = -0.74
VADER_DISTANCE = [1.0, 0.95, 0.9]
VADER_EXCLAMATION = 0.292
VADER_QUESTION = 0.18
VADER_QUESTION_MAX = 0.96
VADER_BEFORE_BUT = 0.5
VADER_AFTER_BUT = 1.5

# Word patterns shared by all text features.
VECTOR_WORD = r"[\p{L}\p{N}_]{2,}"
TOKEN = r"[\p{L}\p{N}_']+|[^\p{L}\p{N}_'\s]"
SENTENCE_END = r"[.!?]+(\s|$)"
PLAIN_WORD = r"[\p{L}\p{N}']+"
VOWELS = r"[aeiouy]+"
SILENT_E = r"[^aeiouy]e$"
