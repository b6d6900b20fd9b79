"""Values that results depend on, kept together as plain text."""

# --- Fixed values -------------------------------------------------------------------------------

# Text clean-up. Java dialect: (?U) makes \s Unicode aware, (?d) lets "." stop at "\n" only.
# Information separators U+001C-U+001F count as white space too.
URL_PATTERN = r"(?U)https?://[^\s\x1c-\x1f]+"
FOOTER_PATTERN = (
    r"(?dU)[\s\x1c-\x1f]*ORCID:[\s\x1c-\x1f]*.*?Content not peer-reviewed by ChemRxiv\. "
    r"License:[\s\x1c-\x1f]*CC BY(?:-[A-Za-z]+)*[\s\x1c-\x1f]*4\.0"
)
FOOTER_MARKER = "ORCID:"  # occurs in every match of the footer pattern
SPACE_PATTERN = r"(?U)[\s\x1c-\x1f]+"
EDGE_SPACE_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# Paragraph filters: strictly more words, strictly higher mean log2 probability.
MIN_WORDS = 50
MIN_SCORE = -20.0
UNKNOWN_WORD = "<unk>"

# TEI documents.
TEI_NAMESPACE = "http://www.tei-c.org/ns/1.0"

# Compound records.
EXCLUDED_REFERENCE = 111
NAMES_HEADING = "Names and Identifiers"
DESCRIPTION_HEADING = "Record Description"
DESCRIPTOR_HEADING = "Computed Descriptors"
FORMULA_HEADING = "Molecular Formula"
SYNONYM_HEADING = "Synonyms"
DEPOSITOR_HEADING = "Depositor-Supplied Synonyms"
SYNONYM_MIN_LENGTH = 3
SYNONYM_MAX_LENGTH = 105
STORED_PREFIX = "cid_"

# Requests and responses.
ID_SEPARATOR = "__"
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
SHARD_NAME = "shard-%03d"
SHARD_SIZE = 50000
MODELS_WITHOUT_TEMPERATURE = ("o3", "o3-mini", "o1", "o1-mini")
FILE_NAME_LIMIT = 255
CALL_TIME_FORMAT = "yyyy-MM-dd HH:mm"
THINK_PATTERN = r"(?sU)<think>[\s\x1c-\x1f]*(.*?)[\s\x1c-\x1f]*</think>[\s\x1c-\x1f]*(.*)"

QUESTION_RESPONSE_FORMAT = {
    "type": "json_schema",
    "json_schema": {
        "name": "QueryGeneration",
        "strict": True,
        "schema": {
            "type": "object",
            "properties": {
                "question": {
                    "type": ["string", "null"],
                    "description": "A question generated from a paragraph.",
                }
            },
            "required": ["question"],
            "additionalProperties": False,
        },
    },
}

# Texts that a CSV reader of data frames takes for a missing value by default.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Our own limits -----------------------------------------------------------------------------

# A word model is broadcast only up to this many rows and bytes of words and doubles.
BROADCAST_MODEL_ROWS = 2_000_000
BROADCAST_MODEL_BYTES = 64 << 20
# Splits of source files whose places are sent to every task (40 bytes each).
MOST_SPLITS = 1_000_000
# Partitions of small files that one task reads, one after the other.
PARTS_PER_TASK = 16
# Exact samples up to this size use one top-k pass; larger ones use counted hash prefixes.
TOP_K_ROWS = 100_000
# Answers that a task holds back before it hands them on.
CALLS_PER_BATCH = 64
# Rows under way per calling thread, and calling threads of a task at most.
CALLS_AHEAD = 4
MOST_THREADS = 64
# Size of a quantile sketch: the larger, the closer.
SKETCH_SIZE = 400
# Rows per numbering block, so that one hot document spreads over tasks.
BLOCK_ROWS = 100_000
