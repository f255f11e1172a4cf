"""Fixed values that results depend on: word lists, tables, patterns, templates."""

# Stop words removed by tokenisation.
STOPWORDS = (
    "the", "a", "and", "or", "to", "of", "in", "on",
    "for", "with", "is", "it", "this", "that",
)

# Critical values of the F distribution at alpha = 0.05, by (df_between, df_within).
F_CRITICAL_05 = {
    (1, 10): 4.96, (1, 15): 4.54, (1, 20): 4.35, (1, 30): 4.17,
    (2, 10): 4.10, (2, 15): 3.68, (2, 20): 3.49, (2, 30): 3.32,
    (3, 10): 3.71, (3, 15): 3.29, (3, 20): 3.10, (3, 30): 2.92,
    (4, 10): 3.48, (4, 15): 3.06, (4, 20): 2.87, (4, 30): 2.69,
}

# ANOVA conclusions.
SIGNIFICANT = "SIGNIFICANT - Reject H0"
NOT_SIGNIFICANT = "NOT SIGNIFICANT - Fail to reject H0"

# E-mail addresses and their replacement.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
EMAIL_MASK = "[REDACTED_EMAIL]"

# Characters blanked out before a value is put into a prompt.
PROMPT_UNSAFE_CHARS = r'[\n\r\t"]'

# Text that must not reach a model through retrieved chunks (matched in lower case).
UNSAFE_CHUNK_PATTERN = (
    r"(ignore\s+previous\s+instructions|system\s+prompt|"
    r"exfiltrate|password|api\s*key)"
)

# Allowed values and defaults of ticket triage.
ISSUE_CATEGORIES = ("login_timeout", "performance", "notifications", "other")
ISSUE_CATEGORY_DEFAULT = "other"
SEVERITIES = ("low", "medium", "high")
SEVERITY_DEFAULT = "medium"
RATIONALE_DEFAULT = "Error processing ticket"
RATIONALE_LENGTH = 100
TRIAGE_SCHEMA = (
    "issue_category string, severity string, "
    "needs_engineering boolean, short_rationale string"
)

# Ticket states that still need work.
ACTIVE_STATUSES = ("open", "in_progress")

# Separator between packed texts.
PACK_SEPARATOR = "\n\n---\n\n"

# Prompt templates; {name} marks the place of a value.
TRIAGE_TEMPLATE = (
    "You are a support triage system. "
    "Analyze the ticket and respond with ONLY valid JSON.\n\n"
    "Required fields:\n"
    "- issue_category: must be exactly one of: "
    '"login_timeout", "performance", "notifications", "other"\n'
    '- severity: must be exactly one of: "low", "medium", "high"\n'
    "- needs_engineering: must be true or false\n"
    "- short_rationale: a brief one-sentence explanation "
    "(keep under 100 characters)\n\n"
    "Ticket Details:\n"
    "Product ID: {product_id}\n"
    "Subject: {subject}\n"
    "Body: {body}\n\n"
    "Respond with only the JSON object, no additional text."
)
SUMMARY_TEMPLATE = (
    "You are a support triage assistant. "
    "Summarize the main issues customers report for product {product_id} "
    "over the last week in 3 bullet points.\n\n"
    "Tickets:\n{ticket_text}"
)
REPLY_TEMPLATE = (
    "Draft a helpful support reply using ONLY the context.\n\n"
    "Ticket:\n{ticket_text}\n\n"
    "Context:\n{context_text}\n\n"
    "Requirements:\n"
    "- 3–6 sentences max.\n"
    '- End with: "Sources: <comma-separated chunk_id list>".\n'
)

# Landing-zone path patterns.
SNAPSHOT_DT_PATTERN = r"snapshot_dt=([0-9]{4}-[0-9]{2}-[0-9]{2})"
SNAPSHOT_TS_PATTERN = r"snapshot_ts=([0-9]{8}T[0-9]{6}Z)"
INGEST_DT_PATTERN = r"ingest_dt=([0-9]{4}-[0-9]{2}-[0-9]{2})"
INGEST_HR_PATTERN = r"ingest_hr=([0-9]{2})"

# Timestamp formats of created_at, tried in this order.
CREATED_AT_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS")

# The one format accepted in live orders.
STREAM_CREATED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Defaults of ingested orders.
BATCH_ORDER_DEFAULTS = {"status": "created", "source": "batch_snapshot"}
STREAM_ORDER_DEFAULTS = {"status": "unknown", "source": "pubsub"}
QUARANTINE_REASON = "failed_minimal_validation"
NON_JSON_ERROR = "non_json_payload"

# Mean earth radius in metres used for point distances.
EARTH_RADIUS_M = 6371010.0
