"""Word lists, label bands, constants and patterns that decide the results.

Everything in this file is data. Changing an entry changes what the operators return.
"""

# --- label bands: closed rating intervals, the first match wins -------------------------
TWO_CLASS_BANDS = [("positive", 7.0, 10.0), ("negative", 1.0, 4.0)]
THREE_CLASS_BANDS = [("positive", 7.0, 10.0), ("neutral", 5.0, 6.99), ("negative", 0.0, 4.99)]
CLASS_ORDER = ["negative", "neutral", "positive"]

# --- loading ----------------------------------------------------------------------------
MIN_TEXT_LENGTH = 10
UNKNOWN_GAME = "unknown"
ANONYMOUS_USER = "anonymous"
COLUMN_ALIASES = {
    "text": ["text", "comment", "review", "content"],
    "rating": ["rating", "value", "score"],
    "game_id": ["game_id", "gameid", "id", "bgg_id"],
    "user": ["user", "username", "user_name", "name", "user_id", "userid"],
}

# --- opinion words (basic lexicon) ------------------------------------------------------
POSITIVE_WORDS = [
    "good", "great", "excellent", "amazing", "wonderful", "fantastic", "awesome", "brilliant",
    "outstanding", "superb", "terrific", "love", "enjoy", "fun", "entertaining", "engaging",
    "exciting", "beautiful", "perfect", "best", "favorite", "recommend", "recommended",
]
NEGATIVE_WORDS = [
    "bad", "terrible", "awful", "horrible", "poor", "worst", "boring", "dull", "tedious",
    "disappointing", "disappointed", "hate", "dislike", "avoid", "waste", "broken", "flawed",
    "frustrating", "annoying", "confusing", "complicated", "difficult",
]

# --- domain vocabulary ------------------------------------------------------------------
DOMAIN_WORDS_SHORT = [
    "mechanics", "mechanic", "strategy", "tactical", "theme", "themed", "components",
    "miniatures", "cards", "dice", "gameplay", "playthrough", "replayability", "replay",
    "complexity", "luck", "skill", "balance", "balanced", "player", "players", "turns", "rounds",
]
DOMAIN_WORDS_LONG = [
    "dice", "roll", "card", "deck", "strategy", "tactics", "mechanic", "worker placement",
    "deck building", "engine building", "area control", "component", "miniature", "token",
    "board", "piece", "tile", "meeple", "artwork", "quality", "production", "rule", "rulebook",
    "setup", "turn", "phase", "round", "player", "gameplay", "playtime", "downtime", "fun",
    "replay", "replayability", "theme", "immersion", "complexity", "balance", "interaction",
    "luck", "skill",
]

# --- degree words -----------------------------------------------------------------------
INTENSIFIERS = [
    "very", "extremely", "incredibly", "absolutely", "completely", "totally", "highly",
    "exceptionally", "remarkably",
]
MITIGATORS = [
    "somewhat", "fairly", "rather", "quite", "pretty", "sort of", "kind of", "a bit", "slightly",
    "moderately",
]

# --- stopwords that carry negation and therefore stay in the text --------------------------
KEPT_STOPWORDS = ["not", "no", "nor", "never", "neither", "hardly", "scarcely", "barely"]

# --- negation cues used when no parser output is supplied ---------------------------------
NEGATION_CUES = ["not", "no", "never", "neither", "hardly", "barely", "n't"]

# --- contractions -----------------------------------------------------------------------
WHOLE_WORD_CONTRACTIONS = {"can't": "cannot", "won't": "will not", "let's": "let us"}
SUFFIX_CONTRACTIONS = {
    "n't": " not", "'ve": " have", "'re": " are", "'ll": " will", "'d": " would", "'m": " am",
    "'s": " is",
}

# --- characters and patterns (valid in Java and in RE2 regular expressions) ----------------
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITESPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WHITESPACE_CHARS = "".join(
    chr(point)
    for low, high in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    ]
    for point in range(low, high + 1)
)
HTML_TAG = r"<[^>]+>"
URL = r"https?://[!$-_a-z]+"
DIGITS = r"\p{Nd}+"
WORD = r"[\p{L}\p{M}\p{N}_]+"
CLITIC_NEGATION = r"(\p{L})([nN]'[tT])"
TOKEN = r"[nN]'[tT]|'[a-zA-Z]+|[\p{L}\p{M}\p{N}_]+|[^\s\p{Z}\p{L}\p{M}\p{N}_]"

# --- part-of-speech classes for dictionary lemmatisation: first letter of the tag -> class ---
POS_CLASSES = {"J": "a", "V": "v", "N": "n", "R": "r"}
DEFAULT_POS_CLASS = "n"

# --- valence normalisation: compound = s / sqrt(s * s + 15) --------------------------------
VALENCE_ALPHA = 15.0

# --- vector sizes and document-frequency limits of the three n-gram representations ---------
NGRAM_FEATURES = {1: 5000, 2: 10000, 3: 15000}
MIN_DF = 2
MAX_DF = 0.95

# --- cleaning step lists ------------------------------------------------------------------
DEFAULT_STEPS = [
    "lowercase", "remove_html", "remove_urls", "remove_numbers", "remove_extra_whitespace",
    "expand_contractions", "stem", "lemmatize_simple", "remove_stopwords",
]
BASIC_STEPS = ["remove_html", "remove_urls", "lowercase", "remove_extra_whitespace"]
FULL_STEPS = [
    "remove_html", "remove_urls", "lowercase", "remove_extra_whitespace", "remove_stopwords",
    "lemmatize",
]

# --- the 23 numeric feature columns, in output order ----------------------------------------
FEATURE_COLUMNS = [
    "positive_word_count", "negative_word_count", "opinion_word_ratio", "negation_count",
    "has_negation", "negated_opinion_words", "intensifier_count", "mitigator_count",
    "has_intensifier", "has_mitigator", "domain_word_count", "domain_word_ratio",
    "has_domain_words", "domain_opinion_overlap", "text_length", "sentence_count", "token_count",
    "avg_sentence_length", "rating", "vader_compound", "vader_positive", "vader_negative",
    "vader_neutral",
]

# --- hyper-parameter grids ------------------------------------------------------------------
NAIVE_BAYES_GRID = {"alpha": [0.01, 0.1, 0.5, 1.0, 2.0], "fit_prior": [True, False]}
SVM_GRID = {"C": [0.01, 0.1, 1.0, 10.0], "loss": ["hinge", "squared_hinge"], "max_iter": [1000, 2500]}
SVM_ITERATIONS, FOREST_TREES = 1000, 100
FOREST_GRID = {
    "n_estimators": [50, 100, 200], "max_depth": [10, 20, None], "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
}
RANDOM_SEARCH_DRAWS = 20
CROSS_VALIDATION_FOLDS = 5
SEED = 42

# --- word-order rules of valence (published constants and word lists) ---------------------------------------

BOOSTER_STEP, CAPITALS_STEP, NEGATION_FACTOR = 0.293, 0.733, -0.74
BOOSTER_DECAY, NEVER_FACTORS = [1.0, 0.95, 0.9], [1.0, 1.5, 1.25]
EXCLAMATION_STEP, QUESTION_STEP, MOST_QUESTIONS = 0.292, 0.18, 0.96
VALENCE_NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither neednt never none "
    "nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent uh-uh without wont wouldnt rarely seldom despite"
).split()
BOOSTERS = (
    "absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially exceptionally "
    "extremely fabulously flipping flippin fricking frickin frigging friggin fully fucking greatly hella highly hugely incredibly "
    "intensely majorly more most particularly purely quite really remarkably so substantially thoroughly totally tremendously uber "
    "unbelievably unusually utterly very"
).split()
DAMPENERS = (
    "almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely slightly somewhat sorta sortof sort-of"
).split()
DAMPENER_PAIRS = ["just enough", "kind of", "sort of"]
VALENCE_IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0, "kiss of death": -1.5,
    "hand to mouth": -2.0,
}
