"""Fixed values that results depend on. They are data, stated as they must be."""

# White space as Python has it (`str.split`, `\s`): first the characters up to
# U+00FF, then the others, which are rare and one range among them.
SPACES_LATIN = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
SPACES_HIGH = "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES_ASCII = "\t\n\x0b\x0c\r "
# What cleaning keeps: letters, digits and white space, ASCII only or of all
# scripts, and these symbols.
KEPT_SYMBOLS = "_-.,;:!?'\""
KEPT_UNICODE = r"\p{L}\p{N}\s"

# Cleaning and chunking.
MIN_CONTENT_CHARS = 50
MIN_CHUNK_CHARS = 20
WORDS_PER_TOKEN = 0.75
CHUNK_TOKENS, OVERLAP_TOKENS = 512, 64
MIN_CHUNK_WORDS, MIN_OVERLAP_WORDS = 50, 10
LOCAL_CHUNK_WORDS, LOCAL_OVERLAP_WORDS = 380, 60
UNKNOWN_LANGUAGE = "unknown"
ARTICLE_HASH_CHARS = 32

# Vectors and retrieval.
EMBEDDING_DIM = 384
MODEL_BATCH = 64
UPSERT_BATCH = 128
BATCHES_PER_RUN = 10
METADATA_TEXT_CHARS = 1000
PREVIEW_TEXT_CHARS = 500
DEFAULT_NAMESPACE = "global"
VECTOR_TOP_K = 8
KEYWORD_TOP_K = 5
KEYWORD_MIN_CHARS = 4
CHUNKS_PER_SAMPLED_ARTICLE = 5

# Zone names allowed in RFC 822 dates.
ZONE_OFFSETS = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

# Text of contexts and prompts.
NO_CONTEXT = "No relevant news context found."
PROMPT_QUERY = "Query: "
PROMPT_CONTEXT = "\n\nRetrieved news context:\n"
PROMPT_CLOSING = "\n\nRespond with structured JSON."
STUB_OUTPUT = "LLM stub: openai_api_key not configured for agent "

# Routing.
TREND, PROCUREMENT = "trend_analyzer", "procurement_planner"
PROCUREMENT_KEYWORDS = ("procure", "supplier", "sourcing", "inventory")
FALLBACK_CONFIDENCE = 0.5
FALLBACK_RATIONALE = "Fallback keyword routing"

# Answer shapes: text key, list keys, other defaults.
TREND_TEXT = "summary"
TREND_LISTS = ("key_trends", "risk_signals", "opportunity_signals", "affected_sectors")
PROCUREMENT_TEXT = "executive_summary"
PROCUREMENT_LISTS = ("supplier_risks", "recommended_actions", "categories_to_watch")
DEFAULT_LEAD_TIME = "medium"
DEFAULT_ANSWER_CONFIDENCE = 0.4
