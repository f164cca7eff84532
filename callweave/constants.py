"""Fixed values.

These must equal what the original workflow used for its outputs and
requests to mean the same thing; they are stated here together, as text.
"""

# --- fixed values -----------------------------------------------------------
# Placeholder written in place of a missing user field and of a failed
# language detection.
NULL_SENTINEL = "null"
# Placeholder printed for a missing name / date / duration in a call header.
MISSING_NAME = "None"
MISSING_DATE = "NaT"
MISSING_NUMBER = "nan"
# Audio and transcript file extensions.
AUDIO_EXT = ".mp3"
TEXT_EXT = ".txt"
# Call id embedded in a CRM recording URL.
CALL_ID_PATTERN = r"calls/(\d+)"
# Header line written before each call's transcript in a bundle.
CALL_HEADER_FORMAT = "Call #{call_no} - {created}, duration {duration} seconds with {agent}"
# Separator after a header and after a transcript inside a bundle.
BLOCK_SEP = "\n\n"
# Speech-to-text request.
TRANSCRIBE_MODEL = "whisper-1"
TRANSCRIBE_FORMAT = "verbose_json"
TRANSCRIBE_TEMPERATURE = 0.0
# Chat requests for translation and summary.
CHAT_MODEL = "gpt-4o"
CHAT_SEED = 42
# Look-back of the periodic pull, in days, and feed page size.
LOOKBACK_DAYS = 15
PAGE_SIZE = 50
# Account cohort: created on or after this instant.
COHORT_CUTOFF = "2024-07-01 00:00:00"
# ---------------------------------------------------------------------------

# Our own wording for the two system prompts (configuration, not a fixed
# value). ``{account_name}`` is filled per account.
TRANSLATE_TEMPLATE = (
    "You receive the transcripts of several phone calls with one customer, "
    "in their original language. Each call starts with a header line of the "
    "form 'Call #<n> - <created>, duration <seconds> seconds with <agent>'.\n"
    "Customer: {account_name}\n"
    "Label each turn as '<agent> (agent)' or '{account_name} (customer)', "
    "write it as 'Speaker: text', translate everything into English without "
    "losing meaning, and return all calls as one text in the same order."
)
SUMMARY_TEMPLATE = (
    "Summarise the translated call history below: list the key points, "
    "commitments and open questions, and keep the nuances."
)
