"""Word lists, patterns and texts that results depend on.

They are stated as plain values because a different list gives different
results; every operator takes them from here and nowhere else.
"""

# English function words counted by the language rule.
STOPWORDS = (
    "the", "be", "to", "of", "and", "a", "in", "that", "have", "it", "for", "not", "on", "with",
    "he", "as", "you", "do", "at", "this", "but", "his", "by", "from", "they", "we", "say", "her",
    "she", "or", "an", "will", "my", "one", "all", "would", "there", "their", "is", "are", "was",
    "were", "can",
)

# Phrases that mark an answer as a refusal.
REFUSAL_PHRASES = (
    "as an ai language model",
    "as an ai assistant",
    "i cannot fulfill",
    "i can't fulfill",
    "i cannot provide",
    "i'm unable to provide",
    "i am unable to provide",
    "i'm sorry, but i cannot",
    "i am sorry, but i cannot",
    "it is not appropriate for me",
    "i do not have personal opinions",
    "i don't have personal opinions",
    "i do not have access to real-time",
)

# Blocked substrings.
BLOCKED_TERMS = ("xxx", "porn", "viagra", "casino bonus", "free download crack")

# Characters stripped from both ends of a token (echo rule, language rule).
ECHO_STRIP = ".,!?;:\"'()[]"
LANGUAGE_STRIP = ".,!?;:\"'()"

# Last characters of a finished answer (a digit or a code fence also counts).
FINAL_CHARS = ".!?\"')]}:;"
CODE_FENCE = "```"

# Personal-data patterns in the order they are applied.
# Written for Java's Unicode mode, with \w spelled out as letters, numbers and underscore.
PII_PATTERNS = (
    ("EMAIL", r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]+"),
    ("CARD", r"\b(?:\d[ -]*?){13,16}\b"),
    ("SSN", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("PHONE", r"(?:\+?\d{1,3}[\s-]?)?(?:\(?\d{3,5}\)?[\s-]?)?\d{3}[\s-]?\d{4}\b"),
)

# What every match of PHONE ends with.
PHONE_CORE = r"\d{3}[\s-]?\d{4}\b"

# Entity names used by the "entity" placeholder style.
PII_ENTITY_NAMES = {
    "EMAIL": "EMAIL_ADDRESS",
    "CARD": "CREDIT_CARD",
    "SSN": "US_SSN",
    "PHONE": "PHONE_NUMBER",
}

# Prompt-injection patterns, searched in the lower-cased message.
INJECTION_PATTERNS = (
    r"ignore (all |your |previous )?(instructions|prompts?|rules)",
    r"disregard (the |your )?(above|previous|system)",
    r"you are now (a |an )?[\p{L}\p{N}_]+",
    r"pretend (you are|to be)",
    r"reveal (your |the )?(system )?(prompt|instructions)",
    r"what (is|are) your (system )?(prompt|instructions)",
)

# Personal data refused in a request, in the order checked.
REQUEST_PII_PATTERNS = (
    ("email", r"\b[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+\b"),
    ("credit_card", r"\b(?:\d[ -]*?){13,16}\b"),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
)

# Placeholders that must not appear in an answer.
BANNED_PLACEHOLDERS = (
    "<LOCATION>",
    "<PERSON>",
    "<DATE_TIME>",
    "<NRP>",
    "<EMAIL_ADDRESS>",
    "<PHONE_NUMBER>",
    "<CREDIT_CARD>",
    "<US_SSN>",
    "<IP_ADDRESS>",
)

# Upper bounds of the latency histogram in seconds (+Inf is added by the operator).
LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

# Fixed value: first line of a retrieved-context block.
CONTEXT_HEADER = (
    "You are answering a technical question. Use ONLY the facts in the context below. "
    "Do not add analogies, explanations, or details not explicitly stated. "
    "Answer concisely and professionally. If a detail isn't in the context, say you don't know..\n"
)

# Reason texts of the release gate and the retrain policy.
GATE_APPROVED = "all gate conditions satisfied"
SIGNALS_QUIET = "all signals within thresholds"

# Reasons of the release gate and of the retrain policy; %s are figures.
GATE_FLOOR = "pass_rate %s < floor %s"
GATE_REGRESSION = "pass_rate %s < baseline %s (regression)"
GATE_CATEGORY = "category '%s' %s < %s"
DRIFT_QUALITY = "quality drift: pass rate %s is %s below baseline"
DRIFT_ERRORS = "error rate %s over ceiling %s"
DRIFT_LATENCY = "p95 latency %ss over SLO %ss"
DRIFT_TOPICS = "data drift: %s of prompts hit no KB context (consider updating the knowledge base, not just retraining)"
DRIFT_ROUTINE = "%s new labelled examples (routine refresh)"
