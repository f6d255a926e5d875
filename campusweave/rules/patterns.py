"""Text patterns. Group 1 is the value unless said otherwise.

The flag U makes white space, digits, word ends and case mean what they mean in Unicode: page
text is full of no-break spaces.
"""

from __future__ import annotations

# College facts in page text.
ESTABLISHED = r"(?iU)(?:Established|Estd\.?|Est\.?)\s*(?:Year)?\s*[:\-]?\s*(\d{4})"
PUBLIC = r"(?iU)public|government|govt|autonomous"
PRIVATE = r"(?iU)private|deemed"
ACCREDITATION = r"(?iU)(?:Accredited|Accreditation|Approved|Approval)\s*(?:By)?\s*[:\-]?\s*([A-Z0-9,\s\(\)\.\-]+)"
AFFILIATION = r"(?iU)(?:Affiliated|Affiliation)\s*(?:To)?\s*[:\-]?\s*([A-Z0-9,\s\(\)\.\-]+)"
BRAND_RANK = r"[^\d#]{0,40}#?(\d{1,3})(?:st|nd|rd|th)?\b"
HEADER_LOCATION_CLASS = r"(?iU)college_header_details|header_info|clg-location"
CITY_STATE = r"(?U)^[A-Za-z\s]+,\s*[A-Za-z\s]+$"
CITY_STATE_MAX = 60
LOCATED_IN = (
    r"(?iU)(?:located in|campus in|situated in|address[:\s])\s*"
    r"([A-Z][a-zA-Z\s]+),\s*([A-Z][a-zA-Z\s]+)"
)

# Listing cards.
LISTING_ROW_CLASS = r"(?iU)table-row"
LISTING_CARD_CLASS = r"(?iU)listing|card|college|result|row|item"
_AMOUNT = r"(?:₹\s*)?([0-9][0-9,]*(?:\.[0-9]+)?(?:\s*(?:LPA|Lakh|Lakhs|Cr|Crore|CPA))?)"
LISTING_METRICS = {
    "listing_avg_package": [
        rf"(?iU){_AMOUNT}\s*(?:Average|Avg\.?)(?:\s+Package|\s+Salary|\s+CTC)?",
        rf"(?iU)(?:Average|Avg\.?)(?:\s+Package|\s+Salary|\s+CTC)[^0-9]{{0,25}}{_AMOUNT}",
    ],
    "listing_highest_package": [
        rf"(?iU){_AMOUNT}\s*(?:Highest|Top)(?:\s+Package|\s+Salary|\s+CTC)?",
        rf"(?iU)(?:Highest|Top)(?:\s+Package|\s+Salary|\s+CTC)[^0-9]{{0,25}}{_AMOUNT}",
    ],
    "listing_placement_percentage": [
        r"(?iU)(\d{1,3}(?:\.\d+)?\s*%)\s*(?:placements?|placed)",
        r"(?iU)(?:placements?|placed)[^0-9]{0,20}(\d{1,3}(?:\.\d+)?\s*%)",
    ],
}
EXPLICIT_RANK = r"(?iU)(?:NIRF(?:\s*Ranking)?|Rank(?:ed)?)\s*(?:[:#]?\s*)?(\d{1,3})(?:st|nd|rd|th)?\b"
LEADING_RANK = r"^#\s*(\d{1,3})\b"
ANY_RANK = r"#\s*(\d{1,3})\b"

# Embedded data.
JSON_LD = r"""(?is)<script\b[^>]*?\btype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
APP_STATE = r"""(?is)<script\b[^>]*?\bid\s*=\s*["']?__NEXT_DATA__["']?[^>]*>(.*?)</script\s*>"""
CONTEXT_COURSE = r'"course_name":"([^"]+)","display_course_name":"([^"]+)"'
CONTEXT_TAG = r'"course_tag":"([^"]+)"'
CONTEXT_FEE = r'"fees_data":\{"amount":(?:"([^"]+)"|([0-9]+(?:\.[0-9]+)?))'
CONTEXT_FORMATTED = r'"amount_formatted":"([^"]+)"'

# Admissions.
SECTION_CLASS = r"(?iU)heading|title|section"
ADMISSION_PROCESS = r"(?idU)Admission Process:? (.*?)(?:\n|$)"

# Placements.
_UNITS = r"(?:LPA|Lakh|Lakhs|Cr|CPA|K)"
LABELLED_PACKAGE = r"[\s\S]{0,60}?(?:INR|Rs\.?)?\s*([0-9][0-9\.]*\s*" + _UNITS + ")"
PACKAGE_LABELS = {
    "highest_package": r"Highest\s*(?:Salary|Package|CTC|Offer)",
    "average_package": r"(?:Average|Avg\.?)\s*(?:Salary|Package|CTC|Offer)",
    "median_package": r"Median\s*(?:Salary|Package|CTC|Offer)",
}
PACKAGE_TABLE_LABELS = {
    "highest_package": r"(?iU)^highest\s*(?:salary|package|ctc|offer)$",
    "average_package": r"(?iU)^(?:average|avg\.?)[\s\S]*?(?:salary|package|ctc|offer)$",
    "median_package": r"(?iU)^median\s*(?:salary|package|ctc|offer)$",
    "top_recruiters": r"(?iU)^top\s*recruiters?$",
}
PACKAGE_SUMMARY = {
    "highest_package": [
        r"(?iU)highest\s+(?:domestic\s+|international\s+)?package(?:\s+offered|\s+was|\s+is|\s+stood\s+at)?(?:\s+of|\s*[:\-])?\s*(?:INR|Rs\.?)\s*([0-9][0-9\.,]*\s*(?:LPA|Lakh|Lakhs|Cr|CPA|crore(?:\s+per\s+annum)?))",
        r"(?iU)highest\s+package(?:\s+offered|\s+was|\s+is|\s+stood\s+at)?(?:\s+of|\s*[:\-])?\s*(?:INR|Rs\.?)\s*([0-9][0-9\.,]*\s*(?:LPA|Lakh|Lakhs|Cr|CPA|crore(?:\s+per\s+annum)?))",
    ],
    "average_package": [
        r"(?iU)average\s+package(?:\s+was|\s+is|\s+stood\s+at|\s+offered)?(?:\s+of|\s*[:\-])?\s*(?:INR|Rs\.?)\s*([0-9][0-9\.,]*\s*(?:LPA|Lakh|Lakhs|Cr|CPA))",
        r"(?idU)average\s+package(?:\s+for\s+(?:mba|the\s+mba|executive\s+mba|pgp|pgp-fabm))?.{0,40}?(?:INR|Rs\.?)\s*([0-9][0-9\.,]*\s*(?:LPA|Lakh|Lakhs|Cr|CPA))",
    ],
    "median_package": [
        r"(?iU)median\s+package(?:\s+was|\s+is|\s+stood\s+at|\s+offered)?(?:\s+of|\s*[:\-])?\s*(?:INR|Rs\.?)\s*([0-9][0-9\.,]*\s*(?:LPA|Lakh|Lakhs|Cr|CPA))",
    ],
    "top_recruiters": [
        r"(?iU)top\s+recruiters(?:\s+include|\s+for\s+the\s+placement\s+drives\s+were)?\s*[-:–]\s*([^<\n\r]+)",
        r"(?iU)top\s+recruiters(?:\s+include|\s+for\s+the\s+placement\s+drives\s+were)?\s+([^<\n\r]+)",
    ],
}
HIGHLIGHTS_START = r"IIM Ahmedabad Placement Highlights.*?MBA Statistics 2025"
HIGHLIGHTS_ENDS = [
    r"IIM Ahmedabad MBA Placement",
    r"IIM Ahmedabad MBA-FABM Placements",
    r"IIM Ahmedabad Executive MBA Placements",
]
_BLOCK_UNITS = r"(?:crore\s+Per\s+annum|crore(?:\s+per\s+annum)?|LPA|Lakh|Lakhs|Cr|CPA)"
HIGHLIGHTS_FIELDS = {
    "highest_package": rf"(?isU)Highest Package.*?INR\s*([0-9][0-9\.,]*\s*{_BLOCK_UNITS})",
    "median_package": rf"(?isU)Median Package.*?INR\s*([0-9][0-9\.,]*\s*{_BLOCK_UNITS})",
    "average_package": rf"(?isU)Average Package.*?INR\s*([0-9][0-9\.,]*\s*{_BLOCK_UNITS})",
    "top_recruiters": r"(?isU)Top Recruiters.*?>(.*?)</td>",
}
PLACEMENT_PERCENTAGE = r"(?iU)(\d+[\.\d]*\s*%\s*(?:placements?|placed|students?))"

# Ranking bodies and their aliases; the site's own brand is added
# after "QS World" at run time.
RANKING_BODIES = [
    ("NIRF", ["NIRF"]),
    ("QS World", ["QS World", "QS World University"]),
    ("QS India", ["QS India"]),
    ("The Week", ["The Week"]),
    ("Outlook", ["Outlook"]),
    ("India Today", ["India Today"]),
    ("IIRF", ["IIRF"]),
]
RANK_PATTERNS = [
    r"(?iU)ranked\s+(\d+)(?:st|nd|rd|th)?[^.]{0,80}<alias>[^\d]*(\d{4})?",
    r"(?iU)<alias>[^.]{0,40}?(?:rank|#)\s*#?(\d+)[^\d]*(\d{4})?",
    r"(?iU)[Rr]ank\s*#?(\d+)[^.]{0,40}<alias>[^\d]*(\d{4})?",
]

# People, money aids and places.
FACULTY_CARD_CLASS = r"(?iU)faculty|teacher|professor|member"
FACULTY_FIELDS = {
    "faculty_name": (["h3", "h4", "span", "td"], r"(?iU)name|title"),
    "designation": (["p", "span", "div", "td"], r"(?iU)designation|desg|role"),
    "department": (["p", "span", "div", "td"], r"(?iU)department|dept"),
}
SCHOLARSHIP_CARD_CLASS = r"(?iU)scholarship|merit|award"
HOSTEL_FEES = r"(?iU)(?:Hostel Fees|Hostel Fee)\s*(?:is|was|of)?\s*(?:INR)?\s*([0-9\.,]+\s*(?:Lakh|Thousand|per|/-)?)"
REVIEW_CARD_CLASS = r"(?iU)review-card|review_card|comment-box"
REVIEW_FIELDS = {
    "reviewer": r"(?iU)reviewer|author|user",
    "rating": r"(?iU)rating|star",
    "body": r"(?iU)text|body|content|desc",
}
FIRST_NUMBER = r"(\d+[\.\d]*)"

# Run log.
LOG_LINE = r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\] ([A-Z]+) \[([^:\]]+):(\d+)\] (.*)$"
