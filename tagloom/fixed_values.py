"""Label names, prompt wording, lookup tables and default bounds.

Everything in this module is data that results depend on literally.  It is kept
together and in plain text so that it can be reviewed at a glance; no logic lives
here.
"""

# The label names of the default label space, sorted.
DEFAULT_LABELS = (
    "cancel_order",
    "change_order",
    "change_shipping_address",
    "check_cancellation_fee",
    "check_invoice",
    "check_payment_methods",
    "check_refund_policy",
    "complaint",
    "contact_customer_service",
    "contact_human_agent",
    "create_account",
    "delete_account",
    "delivery_options",
    "delivery_period",
    "edit_account",
    "get_invoice",
    "get_refund",
    "newsletter_subscription",
    "payment_issue",
    "place_order",
    "recover_password",
    "registration_problems",
    "review",
    "set_up_shipping_address",
    "switch_account",
    "track_order",
    "track_refund",
)

# Wording of the prompts. ``{labels}`` and ``{instruction}`` are holes.
SYSTEM_PROMPT = (
    "You are a customer support intent classifier. "
    "Classify the customer message into exactly one intent. "
    "Respond with only the intent name."
)
ZERO_SHOT_TEMPLATE = (
    "You are a customer support intent classifier. Given a customer message, "
    "classify it into exactly one of the following intents:\n\n"
    "{labels}\n\n"
    "Respond with ONLY the intent name, nothing else.\n\n"
    "Customer message: {instruction}\n"
    "Intent:"
)
FEW_SHOT_TEMPLATE = (
    "You are a customer support intent classifier. Given a customer message, "
    "classify it into exactly one of the following intents:\n\n"
    "{labels}\n\n"
    "Here are some examples:\n\n"
    "{examples}\n\n"
    "Now classify this message:\n"
    "Customer message: {instruction}\n"
    "Intent:"
)
SERVING_FEW_SHOT_TEMPLATE = (
    "Classify the customer message into exactly one intent from:\n"
    "{labels}\n\n"
    "Examples:\n"
    "{examples}"
    'Customer message: "{instruction}"\n'
    "Intent:"
)
FEW_SHOT_EXAMPLE = "Customer message: {example}\nIntent: {intent}"
FEW_SHOT_SEPARATOR = "\n\n"
SERVING_EXAMPLE = 'Customer message: "{example}"\nIntent: {intent}\n\n'
CHAT_TEMPLATE = (
    "<|system|>\n{system}\n"
    "<|user|>\nCustomer message: {instruction}\n"
    "<|assistant|>\n"
)
USER_TURN_PREFIX = "Customer message: "
CHAT_ROLES = ("system", "user", "assistant")

# Outcome of the label matching cascade and its confidence.
STRATEGY_CONFIDENCE = {
    "exact": 1.0,
    "substring": 0.85,
    "fuzzy": 0.7,
    "unknown": 0.0,
}
UNKNOWN_LABEL = "unknown"
FUZZY_CUTOFF = 0.6

# Cleaning bounds, split ratios, seeds, caps and prices.
MIN_TEXT_LENGTH = 5
MAX_TEXT_LENGTH = 500
MIN_REQUEST_LENGTH = 1
MAX_REQUEST_LENGTH = 1000
SPLIT_RATIOS = (("train", 0.70), ("val", 0.15), ("test", 0.15))
DEFAULT_SEED = 42
EXAMPLES_PER_LABEL = 5
LABELS_PER_PROMPT = 5
SERVING_BANK_ENTRIES = 3
SAMPLE_HEAD_ROWS = 100
COST_PER_1K_TOKENS = 0.002
DEFAULT_APPROACH = "fine_tuned"
APPROACHES = ("zero_shot", "few_shot", "fine_tuned")

# Metrics logged per approach, in report order.
LOGGED_METRICS = (
    "accuracy",
    "macro_precision",
    "weighted_precision",
    "macro_recall",
    "weighted_recall",
    "macro_f1",
    "weighted_f1",
    "mean_latency_ms",
    "p95_latency_ms",
    "token_cost_per_1k",
)

# The characters str.strip() removes and str.split() splits on: U+0009 to U+000D,
# U+001C to U+0020, U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
