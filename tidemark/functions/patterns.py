"""Fixed values of the domain: patterns, word lists and lookup tables, shared by columns and document code."""

# --- fixed values: prices and currencies -------------------------------------------------------------
CURRENCY_OF = {"$": "USD", "US$": "USD", "USD": "USD", "€": "EUR", "EUR": "EUR", "£": "GBP", "GBP": "GBP", "rp": "IDR", "IDR": "IDR", "¥": "JPY", "JPY": "JPY", "A$": "AUD", "C$": "CAD", "S$": "SGD"}
PRICE = r"(US\$|A\$|C\$|S\$|\$|€|£|¥|USD|EUR|GBP|IDR|Rp)\s?(\d{1,3}(?:,\d{3})+(?:\.\d{1,6})?|\d+(?:\.\d{1,6})?)(\s?[kKmM]\b)?"
SLOT_GAP = 40
SLOT_PRICES = 6
DISPLAY_SYMBOL = {"USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥", "IDR": "Rp "}
CURRENCY_CODES = r"\b(USD|EUR|GBP|CAD|AUD|SGD|INR|JPY|BRL|MXN|IDR|CHF|SEK|NZD|HKD)\b"
CURRENCY_PREFIXES = r"(?<![A-Za-z])(CA\$|A\$|NZ\$|S\$|HK\$|R\$|US\$|€|£|¥|₹)"
FOREIGN = ("CAD", "AUD", "SGD", "INR", "JPY", "BRL", "MXN", "IDR", "CHF", "SEK", "NZD", "HKD", "EUR", "GBP", "CA$", "A$", "NZ$", "S$", "HK$", "R$", "€", "£", "¥", "₹")

# --- fixed values: billing units ---------------------------------------------------------------------
TIME_UNIT = r"(?:/|per\s+)\s*(month|mo\b|year|yr\b|annually|seat|user|member|editor|credit|request|hour|hr\b|day|gpu-?\s?hour|gpu-?\s?hr\b|vcpu-?\s?hour|vcpu-?\s?hr\b|node-?\s?hour|minute|min\b|second|sec\b)"
OTHER_UNIT = r"(?:/|per\s+)\s*(gib\b|gb\b|tb\b|image|invocation|authorization|invoice|message|token)"
#: Unit words with blanks and hyphens taken out -> canonical unit.
UNIT_OF = {"mo": "month", "month": "month", "minute": "minute", "min": "minute", "second": "second", "sec": "second", "gpuhour": "gpu-hour", "gpuhr": "gpu-hour", "vcpuhour": "vcpu-hour", "vcpuhr": "vcpu-hour", "nodehour": "node-hour", "gib": "GB", "gb": "GB", "tb": "TB", "image": "image", "invocation": "invocation", "authorization": "authorization", "invoice": "invoice", "message": "message", "token": "token", "yr": "year", "year": "year", "annually": "year", "seat": "seat", "user": "user", "member": "user", "editor": "user", "credit": "credit", "request": "request", "hour": "hour", "hr": "hour", "day": "day"}
UNIT_LABEL = {"hour": "per hour", "month": "per month", "year": "per year", "day": "per day", "seat": "per seat", "user": "per user", "credit": "per credit", "request": "per request", "minute": "per minute", "second": "per second", "gpu-hour": "per GPU-hour", "vcpu-hour": "per vCPU-hour", "node-hour": "per node-hour", "GB": "per GB", "TB": "per TB", "image": "per image", "token": "per token", "message": "per message", "invocation": "per invocation", "invoice": "per invoice", "authorization": "per authorization"}
TABLE_UNIT = r"per\s+(?:1\s?m|1,000,000|million|1\s?k|1,000|thousand|1\s?b|billion)(?:\s+\w+)?\s*(?:tokens?|characters?|chars?|pixels?|images?|requests?|minutes?|seconds?)?|/\s*1\s?[mkb]\b|per\s+(?:token|character|image|request|minute|second)s?\b"

# --- fixed values: names -----------------------------------------------------------------------------
NOT_A_NAME = r"^\s*(get started|start free|contact sales|talk to sales|sign up|try |learn more|compare|see all|buy now|choose|select|upgrade|book a demo|everything in|includes everything|all features|plus everything|up to |save |discount|limited time|promo)"
GENERIC_HEADING = r"^\s*(?:pricing|pricing plans?|plans?|our plans?|all plans?|compare plans?|compare|features?|faq|frequently asked questions|questions?|overview|summary|pricing details|how it works|why us|resources|documentation|docs|blog|contact|contact us|support|sales)\s*$|^\s*(?:let'?s talk|talk to|need more|still have|got questions|ready to|not sure)\b"
HEADING_TAIL = r"\b(pricing|prices|harga)\s*$"
FRAGMENT_WORDS = ("by", "and", "or", "the", "a", "an", "per", "from", "to", "for", "with", "in", "on", "at", "of", "up", "new", "more", "all", "each")
NAME_CLASS = r"title|name|plan|tier|heading|header"
FREE_NODE = r"^\s*(free|gratis|\$0(?:\.00)?|no cost)\s*$"
FREE_AT_TOP = r"\b(free|gratis)\b|\$\s?0(?:\.00)?\b"
FREE_NAME = r"^\s*(free|gratis)\b"
MODEL_COLUMN = r"^(model|models|model name|name|engine|endpoint|llm|api|resource|hardware|gpu type|gpu|instance type|instance|sku|tier name|accelerator)$"
MODEL_COLUMN_LOOSE = r"\bmodels?\b"
NOT_MODEL_COLUMN = r"\b(feature|fitur|capabilit|benefit|include)"
NOT_MODELS = ("total", "subtotal", "model", "models", "name", "-", "—")
CELL_PRICE = r"[$€£¥]\s?\d|\d+[.,]\d{2,}"

# --- fixed values: page noise ------------------------------------------------------------------------
DROP_TAGS = ("script", "style", "noscript", "svg", "canvas", "template", "iframe", "object", "embed", "link", "meta", "picture", "source", "audio", "video", "map", "area")
DROP_IDENT = r"cookie|consent|gdpr|onetrust|osano|cky-|announcement-bar|skip-to-content|newsletter-popup|intercom|drift-|hubspot-messages"
PRICE_HINT = r"[$€£¥]\s?\d|\bUSD\b|\bEUR\b|\bRp\s?\d"
KEEP_ATTRS = ("class", "id", "href", "aria-label", "alt", "title", "itemprop", "data-testid")
SECRETS = (
    r"(?i)\bpscale_(?:pw|tkn)_[A-Za-z0-9._\-]{16,}",
    r"\bsk-ant-[A-Za-z0-9._\-]{16,}",
    r"\bsk-[A-Za-z0-9]{20,}",
    r"\bgh[pousr]_[A-Za-z0-9]{30,}",
    r"\bgithub_pat_[A-Za-z0-9_]{40,}",
    r"\bAKIA[0-9A-Z]{16}\b",
    r"\bAIza[0-9A-Za-z._\-]{30,}",
    r"\bxox[baprs]-[A-Za-z0-9\-]{10,}",
    r"\bSG\.[A-Za-z0-9._\-]{20,}",
    r"\b(?:sk|pk|rk)_(?:live|test)_[A-Za-z0-9]{16,}",
    r"\beyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}",
    r"(?i)\b[A-Za-z][A-Za-z0-9]{1,15}_(?:pw|pwd|password|key|token|tkn|secret|api)_[A-Za-z0-9._\-]{16,}",
)
SECRET_MARK = "<secret-redacted>"
VOLATILE = (
    (r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", "<uuid>"),
    (r"(?i)\b[0-9a-f]{16,}\b", "<hex>"),
    (r"\b\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?\b", "<timestamp>"),
    (r"\b\d{10,13}\b", "<epoch>"),
    (r"(?i)\b(?:\d+|an?|one)\s+(?:second|minute|hour|day|week|month|year)s?\s+ago\b", "<relative-time>"),
)
COUNTER_LINE = r"^\d{1,3}(?:[.,]\d+)?\s?[KMB]\+?$"
