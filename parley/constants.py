"""Settings and word lists shared by the operators."""

# ---- Fixed values: they decide results, so they are stated as they must be ----

FILLER_WORDS = (
    "um", "uh", "ah", "yeah", "yep", "okay", "oh", "ohh", "hmm", "hm", "mhm", "mm", "er",
    "yes", "right", "know", "lah", "ll", "ve", "don", "wanna", "gonna", "brilliant",
)

GENERIC_STATEMENTS = (
    "no i'm not sure", "no i am not sure", "i'm not sure", "i am not sure",
    "i'm sorry", "i am sorry", "i'm sorry i'm sorry", "i don't know",
    "i don't know what to do", "i'm calling", "no i'm calling",
    "i need to know", "i need to know more about that", "i need to know the details",
    "if you have any questions", "a few more", "i will get issue", "i've got a",
)
GENERIC_PHRASE = "anything else i can help you with"
EMPTY_STATEMENTS = ("", "n/a", "none", "unknown", "no issue")
HESITATION = r"[\W_]*(?:um|uh|ah|er|hmm)[\W_]*"
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")

REQUEST_CUE = (
    r"\b(?:i['’]d\s+like\s+to|calling\s+(?:because|about|to)|looking\s+for|"
    r"would\s+like\s+to|"
    r"(?:i|we)\s+(?:want|wanted|need|needed|have)\s+to|wondering\s+if|"
    r"talk\s+about|can't|cannot|couldn't|doesn't|didn't|haven't|"
    r"problem\s+with|issue\s+with|supposed\s+to)\b"
)

PROMPT_HEAD = (
    "Extract the customer's main request or complaint as one short phrase from the text. "
    "Do not answer, describe the agent, or invent details.\n"
    "Customer: "
)
PROMPT_TAIL = "\nIssue:"

# Display names of the domain codes.
DOMAIN_LABELS = {
    "agriculture": "Tarım",
    "aviation": "Havacılık",
    "banking": "Bankacılık",
    "deliveryservice": "Teslimat",
    "education": "Eğitim",
    "energy": "Enerji",
    "entertainment": "Eğlence",
    "finance": "Finans",
    "food": "Yiyecek ve İçecek",
    "health": "Sağlık",
    "hospitality": "Konaklama",
    "insurance": "Sigorta",
    "realestate": "Gayrimenkul",
    "retail": "Perakende",
    "technology": "Teknoloji",
    "telecom": "Telekomünikasyon",
    "travel": "Seyahat",
}
ALERT_SUBJECT_WITH_TERMS = ("“", "” terimleriyle ilişkili görüşmelerde")
ALERT_SUBJECT_PLAIN = "Bu sorun kümesindeki görüşmelerde"
ALERT_PREDICATE = " olağandışı artış tespit edildi."
DISPLAY_DASH = "—"
CUT_MARK = "… [kısaltıldı]"
BINARY_MARK = "<ikili veri gösterilmiyor>"

# ---- End of the fixed values ----

# General English stop words: the default list of pyspark.ml.feature.StopWordsRemover.
GENERAL_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
    her hers herself it its itself they them their theirs themselves what which who whom this that
    these those am is are was were be been being have has had having do does did doing a an the and
    but if or because as until while of at by for with about against between into through during
    before after above below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
    i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
    shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
    what's when's where's who's why's would
    """.split()
)


def stop_words(general=GENERAL_STOP_WORDS, fillers=FILLER_WORDS):
    """Union of the general list and the filler list, sorted."""
    return sorted(set(general) | set(fillers))


# What Python's str.strip() removes.
WHITESPACE = "".join(
    chr(code) for code in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# A sentence, one of like meaning, one of another.
SANITY_SENTENCES = (
    "The oven door will not close.",
    "My oven does not shut properly.",
    "Please cancel tomorrow's taxi.",
)

SEED = 42
K_CANDIDATES = (8, 12, 16, 20, 24, 30)
KMEANS_RESTARTS = 5
KMEANS_MAX_ITER = 200
MIN_CLUSTER_SIZE = 5
MAX_CLUSTER_SHARE = 0.20
SILHOUETTE_TOLERANCE = 0.005

CLUSTER_MIN_DF = 3
CLUSTER_MAX_DF = 0.85
CLUSTER_MAX_FEATURES = 12000
CLASSIFIER_MAX_FEATURES = 20000

TEST_SHARE = 0.2
ENCODER_BATCH = 32
GENERATOR_BATCH = 8
PROMPT_VERSION = 6
MAX_INPUT_TOKENS = 128
MAX_NEW_TOKENS = 32
TOKEN_MARGIN = 8
FOCUS_WORDS_BEFORE = 2
FOCUS_WORDS_AFTER = 45
EXCERPT_CHARS = 180
EXCERPT_MIN_SENTENCE = 25
DISPLAY_CHARS = 300

HISTORY_WINDOW = 12
MIN_HISTORY = 12
STD_FLOOR = 1.0
ANOMALY_THRESHOLD = 3.0
MIN_EVENT_COUNT = 8

INPUT_MODE = "customer_text"
DOMAIN_MODEL_NAME = "TF-IDF + Logistic Regression"
LEXICAL_ENCODER_NAME = "hashed TF-IDF (lexical)"
