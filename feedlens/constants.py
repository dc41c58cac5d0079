"""Fixed values.

Everything here is a value that must stay as written for results to match
the documented behaviour: thresholds, rule constants, word lists and
message templates.  Nothing in this module is computed.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: request limits (validation)
# ---------------------------------------------------------------------------
SENTENCE_MIN_CHARS = 1
SENTENCE_MAX_CHARS = 1000
ID_MIN_CHARS = 1
ID_MAX_CHARS = 100
DATASET_MAX_ITEMS = 1000
TOTAL_MAX_ITEMS = 1000
TOTAL_WARN_ITEMS = 500
QUERY_MAX_CHARS = 100
SURVEY_TITLE_MAX_CHARS = 200
THEME_MAX_CHARS = 100
DEFAULT_QUERY = "overview"
MAX_DUPLICATES_LISTED = 5
MSG_EMPTY_SENTENCE = "Sentence cannot be empty after stripping whitespace"

# ---------------------------------------------------------------------------
# FIXED VALUES: sentiment classification thresholds (mode -> threshold)
# ---------------------------------------------------------------------------
THRESHOLDS = {"standard": 0.05, "strict": 0.20}

# ---------------------------------------------------------------------------
# FIXED VALUES: rule-based valence scoring constants (Hutto & Gilbert, 2014)
# ---------------------------------------------------------------------------
BOOST_STEP = 0.293          # booster / dampener step
CAPS_STEP = 0.733           # ALL-CAPS emphasis in mixed-case text
NEGATION_SCALAR = -0.74     # a negation word in the three preceding tokens
BUT_BEFORE = 0.5            # valences before the first "but"
BUT_AFTER = 1.5             # valences after the first "but"
BOOST_DISTANCE_FACTORS = (1.0, 0.95, 0.9)   # preceding token at distance 1, 2, 3
EXCLAIM_STEP = 0.292
EXCLAIM_MAX = 4
QUESTION_STEP = 0.18
QUESTION_MAX_AMPLIFIER = 0.96
NORMALIZE_ALPHA = 15.0

# Booster (intensifying) and dampening words, from the published rule set.
BOOSTER_INCREMENT_WORDS = (
    "absolutely", "amazingly", "awfully", "completely", "considerably",
    "decidedly", "deeply", "enormously", "entirely", "especially",
    "exceptionally", "extremely", "fabulously", "flipping", "fully",
    "greatly", "hella", "highly", "hugely", "incredibly", "intensely",
    "majorly", "more", "most", "particularly", "purely", "quite", "really",
    "remarkably", "so", "substantially", "thoroughly", "totally",
    "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
)
BOOSTER_DECREMENT_WORDS = (
    "almost", "barely", "hardly", "kind of", "kinda", "kindof", "less",
    "little", "marginally", "occasionally", "partly", "scarcely", "slightly",
    "somewhat", "sort of", "sorta", "sortof",
)
NEGATION_WORDS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
    "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom",
    "despite",
)

# ---------------------------------------------------------------------------
# FIXED VALUES: small hand-written English valence lexicon (token, -4..4).
# The full published lexicon is not shipped; callers pass their own table.
# ---------------------------------------------------------------------------
STARTER_LEXICON = (
    ("amazing", 2.8), ("awesome", 3.1), ("bad", -2.5), ("beautiful", 2.9),
    ("best", 3.2), ("better", 1.9), ("boring", -1.3), ("broken", -2.1),
    ("buggy", -1.8), ("clean", 1.7), ("confusing", -1.3), ("convenient", 1.6),
    ("crash", -1.7), ("crashes", -1.7), ("delicious", 2.7), ("delight", 2.9),
    ("disappointed", -1.9), ("disappointing", -2.2), ("easy", 1.9),
    ("excellent", 2.7), ("expensive", -0.9), ("fail", -2.3), ("failed", -2.3),
    ("fantastic", 2.6), ("fast", 0.9), ("fine", 0.8), ("frustrated", -2.1),
    ("frustrating", -1.9), ("glad", 2.0), ("good", 1.9), ("great", 3.1),
    ("happy", 2.7), ("hate", -2.7), ("helpful", 1.8), ("horrible", -2.5),
    ("informative", 1.3), ("intuitive", 1.6), ("issue", -0.7),
    ("issues", -0.8), ("lag", -1.0), ("like", 1.5), ("love", 3.2),
    ("loved", 2.9), ("mess", -1.5), ("nice", 1.8), ("perfect", 2.7),
    ("pleasant", 2.3), ("poor", -2.1), ("problem", -1.7), ("problems", -1.7),
    ("recommend", 1.5), ("reliable", 1.7), ("sad", -2.1), ("satisfied", 1.8),
    ("slow", -1.2), ("smooth", 1.3), ("terrible", -2.5), ("unhappy", -1.8),
    ("unreliable", -1.6), ("useful", 1.9), ("useless", -1.8), ("waste", -1.8),
    ("worse", -2.1), ("worst", -3.1), ("wow", 2.8), ("wonderful", 2.7),
    ("wrong", -2.1), (":)", 2.0), (":(", -1.9),
)

# ---------------------------------------------------------------------------
# FIXED VALUES: keyword extraction
# ---------------------------------------------------------------------------
MAX_KEYWORDS = 10
MAX_DF = 0.85
MIN_DF = 1
MAX_FEATURES = 100
TOP_BIGRAMS = 5
TOP_UNIGRAMS = 10
FALLBACK_TOP = 10
# stop words of the word-frequency fallback
FALLBACK_STOP_WORDS = (
    "the", "and", "for", "with", "this", "that", "from",
    "have", "has", "was", "were", "been", "are", "not",
)
PHRASE_MIN_COUNT = 2
PHRASE_TOP = 5
TITLE_MAX_CHARS = 50
TITLE_CUT_CHARS = 47
GENERAL_TITLE = "General Feedback"
EMPTY_TITLE = "Empty Cluster"

# Latin accents folded by keyword tokenising (lower-case source -> target).
ACCENT_FROM = "àáâãäåāăąçćĉċčďèéêëēĕėęěĝğġģĥìíîïĩīĭįĵķĺļľñńņňòóôõöōŏőŕŗřśŝşšţťùúûüũūŭůűųŵýÿŷźżž"
ACCENT_TO = "aaaaaaaaacccccdeeeeeeeeegggghiiiiiiiijklllnnnnoooooooorrrssssttuuuuuuuuuuwyyyzzz"

# ---------------------------------------------------------------------------
# FIXED VALUES: template insights
# ---------------------------------------------------------------------------
SHARE_RELATES_PCT = 30
SHARE_MENTIONS_PCT = 15
STRONG_SENTIMENT_PCT = 70
MAJORITY_SENTIMENT_PCT = 50
STRONG_AVG = 0.7
MODERATE_AVG = 0.5
PHRASE_SHARE = 0.3
KEYWORD_SHARE = 0.5
VOLUME_SIZE = 20
MAX_INSIGHTS = 3

# ---------------------------------------------------------------------------
# FIXED VALUES: clustering
# ---------------------------------------------------------------------------
N_COMPONENTS = 5
MAX_CLUSTERS = 10
NOISE_THRESHOLD = 0.5
RANDOM_STATE = 42
MIN_SAMPLES_FOR_CLUSTERING = 3
KMEANS_MAX_ITER = 300
