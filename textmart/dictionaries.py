"""Dictionaries the jobs default to.

Everything below the FIXED VALUES marker must stay equal to the values the
original analyses used, so that results agree. Large lists (the 1983-word
Ukrainian stop-word list, topic keyword profiles, lemma dictionaries) are not
embedded; they are read from user-supplied files with ``textmart.sources``.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original analyses; natural order, unchanged)
# ---------------------------------------------------------------------------

# Letter class of the "clean text" tokenizer: everything else becomes a space.
CLEAN_LETTERS = "а-яяіїєґa-z"

# Token pattern of the comparative-corpus tokenizer (after lower-casing and
# replacing the typographic apostrophe ’ with ').
TOKEN_LETTERS = "a-zа-щьюяєіїґ'"

# English stop words (127 entries).
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these",
    "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "should", "now",
]

# Suffixes of the Ukrainian stemmer, tried in this order.
STEM_SUFFIXES = [
    "ування", "ювання", "ення", "ання", "ями", "ові", "еві", "ими", "ого", "ому",
    "ами", "ях", "ах", "ям", "ем", "ом", "ою", "ею", "ий", "ій",
    "а", "я", "у", "ю", "і", "и", "о", "е", "ь",
]

# Sentiment lexicon (lemmas).
POSITIVE_LEMMAS = [
    "успіх", "перемога", "відновлення", "розвиток", "підтримка", "допомога", "врятувати",
    "стабільний", "ефективний", "покращення", "зростання", "безпека", "захист",
    "досягнення", "інновація", "мир", "сильний", "надія", "позитивний",
]
NEGATIVE_LEMMAS = [
    "війна", "обстріл", "атака", "вибух", "загибель", "поранення", "криза", "корупція",
    "загроза", "руйнування", "втрата", "дефіцит", "блокада", "санкція", "злочин",
    "аварія", "пожежа", "катастрофа", "небезпека", "тривога",
]

# Parts of the day: [0,12) morning, [12,18) midday, rest evening; display order.
PERIODS = ["Ранок", "Обід", "Вечір"]

# News category mapping for the supervised classifier; unmapped -> "other".
CATEGORY_MAPPING = {
    "politics": "political",
    "economics": "economic",
    "life": "social",
    "sport": "social",
    "technologies": "technologies",
    "defence": "technologies",
    "other": "social",
}

# URL prefix rules for article categories, first match wins, default "other".
URL_CATEGORY_RULES = [
    ("politics", "https://www.pravda.com.ua/"),
    ("politics", "https://www.eurointegration.com.ua/"),
    ("economics", "https://epravda.com.ua/"),
    ("life", "https://life.pravda.com.ua/"),
    ("technologies", "https://mezha.ua/"),
    ("defence", "https://oboronka.mezha.ua/"),
    ("sport", "https://champion.com.ua/"),
]

# Job-ad filter keywords (title or content).
ANALYST_FILTER_KEYWORDS = [
    "data analyst", "аналітик даних", "business analyst", "bi analyst",
    "product analyst", "marketing analyst", "analytics",
]

# Technology tags and their aliases, in dictionary order.
TECH_KEYWORDS = {
    "SQL": ["sql", "postgresql", "mysql", "oracle", "bigquery"],
    "Python": ["python", "pandas", "numpy", "scipy"],
    "Excel": ["excel", "spreadsheet"],
    "Tableau": ["tableau"],
    "Power BI": ["power bi", "powerbi"],
    "R": [" r ", " r,", "r language", "rstudio"],
    "Spark": ["spark", "pyspark"],
    "Airflow": ["airflow"],
    "Looker": ["looker"],
    "ClickHouse": ["clickhouse"],
    "dbt": ["dbt"],
    "ETL": ["etl", "elt"],
}

# Seniority rules, tried in order; default "Not Specified".
LEVEL_RULES = [
    ("Lead/Head", ["lead", "head", "principal"]),
    ("Senior", ["senior", "sr.", "5+"]),
    ("Middle", ["middle", "mid", "2-3", "3+"]),
    ("Junior", ["junior", "jr.", "entry", "trainee"]),
]
LEVEL_ORDER = ["Junior", "Middle", "Senior", "Lead/Head", "Not Specified"]

# Experience-years pattern (the first of the original four; it always wins).
EXPERIENCE_PATTERN = r"(\d+)\+?\s*(?:years?|років|роки|рік)"
EXPERIENCE_CAP = 10
EXPERIENCE_BANDS = ["0 (Junior)", "1-2 років", "3-4 років", "5+ років"]

# Parts of speech that the topic classifier keeps when lemmas come from a dictionary.
TOPIC_POS = ["NOUN", "VERB", "ADJ", "PROPN"]

# Emotion labels, decision thresholds and tonality groups.
EMOTION_LABELS = ["Joy", "Fear", "Anger", "Sadness", "Disgust", "Surprise", "None"]
EMOTION_THRESHOLDS = {
    "Joy": 0.35,
    "Fear": 0.5,
    "Anger": 0.25,
    "Sadness": 0.5,
    "Disgust": 0.3,
    "Surprise": 0.25,
    "None": 0.35,
}
POSITIVE_EMOTIONS = ["Joy", "Surprise"]
NEGATIVE_EMOTIONS = ["Fear", "Anger", "Sadness", "Disgust"]
NEUTRAL_EMOTION = "None"

# Job-ad word lists.
ANALYST_KEYWORDS = [
    "data analyst", "product analyst", "bi analyst", "bi developer",
    "business intelligence", "analytics", "marketing analyst", "senior data analyst",
    "middle data analyst", "junior data analyst",
]
CUSTOM_STOP_WORDS = [
    "experience", "work", "team", "company", "role", "looking", "join", "ability", "strong", "working", "etc",
    "e.g", "eg", "year", "years", "also", "least", "including", "well", "new", "us", "one", "use", "using",
    "used", "day", "would", "need", "ensure", "make", "like", "good", "plus", "based", "across", "level",
    "high", "key", "must", "related", "knowledge", "understanding", "skill", "skills", "candidate", "ideal",
    "offer", "offers", "responsibilities", "requirement", "requirements", "required", "nice", "hiring",
    "description", "job", "position", "opportunity", "opportunities", "want", "help", "look", "seek",
    "seeking", "right", "create", "full", "best", "real", "world", "global", "part", "first", "within",
    "time", "support", "people", "professional", "environment", "take", "develop", "provide", "different",
    "major", "apply", "available", "following", "willingness",
]
MEANINGFUL_TERMS = [
    "datum", "data", "analysis", "report", "dashboard", "metric", "insight", "business", "product", "query",
    "visualization", "test", "performance", "funnel", "retention", "segment", "monitor", "model",
    "automation", "pipeline", "decision", "stakeholder", "conversion", "kpi",
]
TECH_PATTERNS = [
    "sql", "python", "tableau", "power bi", "powerbi", "excel", "bigquery", "big query",
    "clickhouse", "postgresql", "postgres", "mysql", "snowflake", "redshift", "looker",
    "looker studio", "google analytics", "ga4", "dax", "power query", "etl", "elt",
    "airflow", "dbt", "spark", "hadoop", "aws", "gcp", "azure", "docker", "git", "github",
    "pandas", "numpy", "matplotlib", "seaborn", "plotly", "scipy", "scikit", "tensorflow",
    "pytorch", "jupyter", "databricks", "metabase", "superset", "amplitude", "mixpanel",
    "hotjar", "firebase", "appsflyer", "gtm", "google tag manager", "jira", "confluence",
    "notion", "ab_test", "a/b test", "ab test", "machine learning", "deep learning",
    "statistics", "statistical", "r language", "r programming",
]
REQUIREMENT_CATEGORIES = {
    "Hard Skills (Технічні навички)": [
        "sql", "python", "excel", "statistics", "statistical", "machine learning",
        "ab_test", "etl", "dax", "power query", "modeling", "programming", "scripting",
        "automation",
    ],
    "BI & Візуалізація": [
        "tableau", "power bi", "powerbi", "looker", "looker studio", "metabase",
        "superset", "dashboard", "visualization", "reporting", "report",
    ],
    "Бази даних та Хмарні платформи": [
        "bigquery", "big query", "clickhouse", "postgresql", "postgres", "mysql",
        "snowflake", "redshift", "databricks", "aws", "gcp", "azure",
    ],
    "Аналітичні платформи": [
        "google analytics", "ga4", "amplitude", "mixpanel", "hotjar", "firebase",
        "appsflyer", "gtm",
    ],
    "Soft Skills": [
        "communication", "english", "teamwork", "presentation", "problem solving",
        "analytical thinking", "attention detail", "proactive", "independent",
    ],
}

# Sentinels and formats.
CONTENT_NOT_FOUND = "[Content structure not found]"
DAY_FORMAT = "dd.MM.yyyy"
TOPIC_THRESHOLD = 0.05
UNKNOWN_TOPIC = "unknown"
