"""Fixed values.

Everything in this module is data that results depend on: names, word lists,
patterns, thresholds and model settings. Change a value here and results change.
"""

# --- Fixed values: model settings -------------------------------------------

SEED = 42
SPLIT_SHARES = {"train": 0.70, "validation": 0.15, "test": 0.15}
CV_FOLDS = 3
REG_PARAMS = [0.001, 0.01, 0.1]
ELASTIC_NET_PARAMS = [0.0, 0.1, 0.3, 0.5, 0.7, 1.0]
LOGISTIC_MAX_ITER = 50
BIGRAM_VOCABULARY = 50000
BIGRAM_MIN_DF = 3
TOPIC_COUNT = 5
TOPIC_MAX_ITER = 20
TOPIC_VOCABULARY = 5000
TOPIC_MIN_DF = 5
TOPIC_MAX_DF = 0.8
TOPIC_MIN_TOKEN = 3
TOPIC_TERMS = 10
TOPIC_KEYWORDS = 5
SEGMENT_INPUTS = [
    "text_len", "sentiment_score", "review_len", "summary_len", "rate_score", "word_count",
    "topic_0", "topic_1", "topic_2", "topic_3", "topic_4",
]
SEGMENT_RANGE = (2, 5)
SEGMENT_MAX_ITER = 20

# --- Fixed values: reports and alerts ---------------------------------------

ALERT_SHARE = 70.0
ALERT_TYPE = "high_negative"
ALERT_MESSAGE = "High negative sentiment: %.0f%% in batch"
RECENT_REVIEWS = 5000
RECENT_ALERTS = 10
SHOWN_ALERTS = 3
RECENT_EVALUATIONS = 10
TOP_TOPICS = 5

# --- Fixed values: default names when no interpretation has been saved -------

DEFAULT_TOPIC_NAMES = [
    (0, "Product Quality"),
    (1, "Delivery & Shipping"),
    (2, "Price & Value"),
]
DEFAULT_SEGMENT_NAMES = [
    (0, "Critical Issues"),
    (1, "Satisfied Customers"),
    (2, "Mixed Feedback"),
]

# --- Fixed values: topic themes and the keywords that vote for them ----------

TOPIC_THEMES = {
    "Delivery & Shipping": [
        "delivery", "shipping", "arrived", "package", "delayed", "received", "courier",
    ],
    "Price & Value": [
        "purchase", "price", "expensive", "cheap", "cost", "money", "affordable", "budget",
        "deal", "rupees", "rs", "value", "penny",
    ],
    "Customer Service": [
        "service", "support", "help", "staff", "call", "response", "representative", "care",
    ],
    "Product Features": [
        "battery", "camera", "screen", "memory", "color", "design", "feature", "specification",
        "display", "sound", "machine",
    ],
    "Product Quality": [
        "quality", "defective", "durable", "broken", "damaged", "condition", "build", "product",
    ],
    "General Sentiment": [
        "excellent", "good", "bad", "nice", "best", "worst", "great", "awesome", "terrific",
        "fabulous", "super", "poor", "perfect",
    ],
}
THEME_MIN_OVERLAP = 2

# --- Fixed values: words a topic may not be made of, besides English stop words

TOPIC_SENTIMENT_WORDS = [
    "good", "bad", "best", "worst", "excellent", "poor", "great", "terrible", "awesome",
    "horrible", "amazing", "awful", "nice", "fabulous", "perfect", "wonderful", "mindblowing",
    "terrific", "super", "happy", "love", "hate",
]
TOPIC_DOMAIN_WORDS = [
    "flipkart", "amazon", "really", "brilliant", "expectations", "disappointed", "wow", "thank",
    "thanks", "one", "also", "every", "simply", "must", "working", "used", "use", "using",
]

# --- Fixed values: Spark ML's default English stop words, for the SQL checks --

ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]

# --- Fixed values: segment naming, first matching rule wins -------------------
# (name, description, sentiment bound, rating bound); "below" rules need both
# averages strictly under their bounds, "above" rules strictly over them.

SEGMENT_RULES = [
    ("below", 0.3, 2.5, "Critical Issues",
     "High negative sentiment, urgent complaints requiring attention"),
    ("below", 0.5, 3.5, "Complaints & Concerns",
     "General complaints and customer concerns"),
    ("above", 0.7, 4.0, "Satisfied Customers",
     "Positive reviews from happy customers"),
    ("above", 0.5, 3.5, "Generally Positive",
     "Mostly positive feedback with minor issues"),
]
SEGMENT_OTHERWISE = ("Mixed Feedback", "Balanced sentiment with varied customer experiences")
LONG_REVIEW = (200, " (Detailed)", " - Detailed reviews")
SHORT_REVIEW = (50, " (Brief)", " - Brief feedback")
