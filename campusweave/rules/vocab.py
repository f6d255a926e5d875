"""Word lists, page types, markers and limits."""

from __future__ import annotations

# Page type -> address suffix.
PAGE_SUFFIXES = {
    "info": "",
    "courses": "/courses-fees",
    "admissions": "/admission",
    "placements": "/placement",
    "reviews": "/reviews",
    "faculty": "/faculty",
    "scholarships": "/scholarship",
    "hostel": "/hostel",
    "cutoff": "/cutoff",
}

# Address shapes.
PROFILE_URL = r"/(colleges?|university)/\d+"
PROFILE_PARTS = r"/(colleges?|university)/(\d+)-([^/?#]+)"
SUBPAGE_URL = (
    r"(?i)/(courses?-fees?|admission|placement|reviews?|faculty|scholarship|hostel|cutoff"
    r"|ranking|gallery|news|contact|about|infrastructure|alumni|events?)/?$"
)
AUDIT_SUBPAGE_URL = (
    r"(?i)/(ranking|courses-fees|placement|admission|reviews|faculty|scholarship|hostel|cutoff)/?$"
)
SAVED_PAGE_NAME = r"([^/]+)/(\d+)_([^/]+)\.html$"

# Signs of a blocked fetch.
BLOCK_MARKERS = [
    "the request could not be satisfied",
    "generated by cloudfront",
    "403 error",
    "access denied",
    "attention required",
]
BLOCK_MIN_CHARS = 2000

# Parts of a page that are not its content.
NOISE_TAGS = ["script", "style", "noscript", "aside", "nav", "footer"]
NOISE_CLASS_PARTS = [
    "sidebar", "latest-questions", "related-questions", "question-wrapper", "college-sidebar",
    "news-sidebar", "ad-", "ads", "advert", "banner", "popup", "modal", "cookie", "newsletter",
    "social",
]

# Vocabularies, in output order.
ADMISSION_EXAMS = ["JEE Advanced", "JEE Main", "GATE", "CAT", "IIT JAM", "CEED", "UCEED", "UGC NET"]
RECRUITERS = [
    "Microsoft", "Google", "Amazon", "Accenture", "TCS", "Infosys", "Wipro", "Cognizant", "HCL",
    "Intel", "Cisco", "Jane Street", "Goldman Sachs", "Flipkart",
]
RECRUITER_NOISE = [
    "openGraph", "schemaJsonLd", "breadcrumb", '"description"', '{"@context"', "u003c",
    "http://schema.org",
]
RECRUITER_MARKUP = ["<", ">", '\\"', '">', "</"]
RECRUITER_MAX_CHARS = 300
FACILITIES = [
    "Wi-Fi", "Gym", "Laundry", "Mess", "AC Rooms", "Single Occupancy", "Double Occupancy", "Sports",
]

# Words that mark a row as a fee line and not a course.
FEE_WORDS = [
    "fee", "fees", "charge", "charges", "chrage", "chrages", "stipend", "deposit",
    "expense", "expenses", "particulars", "amount", "living", "refundable",
    "hostel", "utility", "utilities", "payment", "gst", "tax", "caution",
    "establishment", "annual", "academic year", "stipend structure",
    "indian students", "saarc", "non-saarc", "international students",
    "boys", "girls", "mess", "electricity",
]
YEAR_LABEL = r"^\s*(\d+(?:st|nd|rd|th)?\s*year|year\s*\d+)\s*$"

# Course tables.
HEADER_CELLS = [
    "course", "courses", "m.tech specializations", "b.tech specializations",
    "m.sc specializations", "m.tech courses", "b.tech courses", "m.sc courses",
]
HEADER_PHRASES = ["total fees", "fees (inr)", "specializations"]
SCANNED_HEADER_CELLS = [
    "course", "specialization", "specializations", "pgpm specializations", "pg program specializations",
]
FEE_TABLE_WORDS = [
    "particular", "fee", "stipend", "expense", "deposit", "charge", "chrage",
    "breakdown", "category", "year", "component", "detail", "cost",
]
IRRELEVANT_HEADINGS = [
    "comparison", "compared with", "placement", "salary", "package", "recruiters",
    "admission dates", "cutoff", "cut off", "reviews", "ranking", "faq", "question", "answer",
]
COURSE_COLUMN_WORDS = [
    "course", "specialization", "specialisation", "degree", "program", "programme", "branch",
    "stream", "subject",
]
FEE_COLUMN_WORDS = ["fee", "fees", "inr", "amount", "price", "cost"]
MONEY_CELL = r"(?i)INR|\bRs\b|\bLakh\b|\bLakhs\b|^\s*[0-9\.,\-]+\s*$"

# Headings of the admissions page, (column, phrases, longest text kept).
ADMISSION_SECTIONS = [
    ("admission_process", ["admission process", "selection criteria"], 1000),
    ("exams_accepted", ["exam accepted", "entrance exam"], 500),
    ("eligibility_criteria", ["eligibility criteria"], 1000),
    ("important_dates", ["important dates"], 1000),
    ("application_deadlines", ["application deadline"], 500),
]

# Limits.
AGENCY_TEXT_CHARS = 250
REVIEW_CHARS = 1000
FACULTY_LINE_CHARS = 100
FACULTY_LINES = 15
SCHOLARSHIP_CARD_CHARS = 200
RANK_MAX = 50000
TEXT_RANK_MAX = 5000
RANK_YEARS = (2000, 2030)
CONTEXT_BEFORE = 900
CONTEXT_AFTER = 1400
RANK_SCOPE_LEVELS = 5
STAGNANT_PAGES = 3
