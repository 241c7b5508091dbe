"""Fixed values.

These literals decide results (labels, word lists, patterns, weights), so they are
stated once, as plain text, and imported everywhere else.
"""

# Directory domain -> source label. Checked in this order; first hit wins.
SOURCE_DOMAINS = {
    "justdial.com": "Justdial",
    "indiamart.com": "IndiaMART",
    "tradeindia.com": "TradeIndia",
}
SOURCE_SLUGS = ["justdial", "indiamart", "tradeindia"]
PAGINATED_SITES = ["indiamart", "tradeindia"]
KNOWN_SITES = ["justdial", "indiamart", "tradeindia"]

# Hosts that are never a company's own website.
DIRECTORY_DOMAINS = [
    "facebook.com", "twitter.com", "linkedin.com", "instagram.com",
    "youtube.com", "justdial.com", "indiamart.com", "tradeindia.com",
    "tistatic.com", "tradeudhaar.com", "getdistributors.com",
    "google.com", "whatsapp.com", "googletagmanager.com", "schema.org",
    "w3.org",
]

# Contacts printed on every page of a directory: never company-specific.
SITE_WIDE_PHONES = ["01146710423"]
SITE_WIDE_EMAILS = ["helpdesk@tradeindia.com"]

# Company-name words dropped by normalization.
LEGAL_WORDS = [
    "pvt", "ltd", "llp", r"private\s*limited", "opc", "inc", "corp",
    "corporation", "llc", "limited", "co", "company",
]
DESCRIPTOR_WORDS = [
    "technologies", "solutions", "services", "systems", "group",
    "industries", "enterprises?",
]

# Contact patterns.
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
MOBILE_PATTERN = r"(?<!\d)(?:\+?91[-\s]?)?[6-9]\d{9}(?!\d)"
INTERNATIONAL_PATTERN = r"(?<!\d)\+\d{1,3}[-\s]?\d{1,4}[-\s]?\d{6,8}(?!\d)"
LANDLINE_PATTERN = r"(?<!\d)0\d{2,4}[-\s]?\d{6,8}(?!\d)"
URL_PATTERN = r"https?://[-\w.%+]+[-\w/?=&+#]*"
UNVERIFIED_PREFIX = "UNVERIFIED:"

# Listing-name patterns per site, tried in order.
NAME_PATTERNS = {
    "justdial": [r"<h2[^>]*data-name[^>]*>([^<]+)</h2>", r'"name"\s*:\s*"([^"]+)"'],
    "indiamart": [r'"CMP"\s*:\s*"([^"]+)"', r"<h2[^>]*>([^<]+)</h2>"],
    "tradeindia": [
        r'<h3[^>]*class="company-url"[^>]*>\s*([^<]+)\s*</h3>',
        r'"company_name"\s*:\s*"([^"]+)"',
    ],
}

# Columns that may carry a phone number in legacy rows.
LEGACY_PHONE_COLUMNS = [
    "phone", "mobile", "phone1", "phone2", "phone3", "phone4", "raw_phone", "alt_phone",
]

# JSON-LD types accepted as a business (a block without a type is accepted too).
BUSINESS_TYPES = ["LocalBusiness", "Organization", "Business"]

# Response codes read as "blocked"; a 200 below the byte floor is blocked as well.
BLOCKED_STATUS_CODES = [401, 403, 407, 429, 444, 500, 502, 503, 504]
BLOCKED_BODY_BYTES = 500

# Lead score weights and tiers.
SCORE_PHONE, SCORE_EMAIL, SCORE_WEBSITE = 25, 15, 15
SCORE_THREE_SOURCES, SCORE_TWO_SOURCES = 35, 25
SCORE_NEW, SCORE_LAST_WEEK = 10, 5
SCORE_ICP, SCORE_CAP = 10, 100
SEED_EMAIL, SEED_PHONE, SEED_WEBSITE, SEED_INDUSTRY = 25, 25, 20, 10

FAILURE_LIMIT = 0.3
FUZZY_THRESHOLD = 90
DETAIL_BUDGET = 20
DEFAULT_MAX_PAGES = 10

# Column orders of the flat exports.
LEAD_EXPORT_COLUMNS = [
    "company_name", "website", "email", "phone", "address",
    "industry_code", "employee_count", "revenue_band", "source_url",
    "scraped_at", "dedup_key", "lead_score", "lead_score_breakdown",
    "category_slug",
]
REJECTED_EXPORT_COLUMNS = [
    "dedup_key", "kept_company", "rejected_company", "reason", "timestamp",
]
ERROR_EXPORT_COLUMNS = ["url", "timestamp", "error_type"]
REVIEW_LOG_COLUMNS = [
    "timestamp", "action", "incoming_name", "incoming_normalized",
    "candidate_name", "candidate_normalized", "score", "threshold", "verdict",
]
