"""Fixed values that results must agree on.

Everything here is a literal that the triage workflow's outputs are
compared against (status words, the catch-all category, null tokens,
whitespace set). Keep them as plain text in natural order.
"""

# --- fixed values: result status words -------------------------------
STATUS_OK = "成功"            # parsed, both fields present
STATUS_PARSE_FAIL = "解析失败"  # reply arrived but could not be parsed
STATUS_REQUEST_FAIL = "请求失败"  # transport error, timeout, or unusable body
FAILED_STATUSES = (STATUS_PARSE_FAIL, STATUS_REQUEST_FAIL)

# --- fixed values: categories ----------------------------------------
CATCH_ALL_CATEGORY = "其他违法行为"
SELF_MADE_MARKER = "(自创)"
CATEGORY_SEP = "||"

# --- fixed values: reply grammar -------------------------------------
CATEGORY_LABEL = "违规类别"
REASON_LABEL = "判断理由"
JUDGE_WORD = "判断"

# --- fixed values: preview tags for the triage label -----------------
TAG_NEEDS_EXPERT = "需AI"
TAG_RULES_ONLY = "免AI"

# --- fixed values: result column names -------------------------------
RESULT_COLUMNS = ("ai_violation_categories", "ai_reason", "ai_raw_response", "process_status")
RAW_REPLY_MAX_CHARS = 500

# --- fixed values: cells a pandas CSV reader turns into NaN by default ---
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- fixed values: characters Python's str.strip() treats as whitespace ---
# As a regex character class that both Java regex and RE2 accept.
WS_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# --- fixed values: default request settings --------------------------
REQUEST_TEMPERATURE = 0.3
REQUEST_MAX_TOKENS = 500
DEFAULT_MODEL_NAME = "offline-rules"
DEFAULT_SYSTEM_PROMPT = "You classify administrative case records into violation categories."
