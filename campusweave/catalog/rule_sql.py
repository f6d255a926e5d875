r"""The rules on degrees, courses and tables once more, as plain SQL for DuckDB.

Written apart from ``rules/``: a rule that is wrong there does not agree with what is said here. ``t`` is a degree tag in lower
case with single blanks, ``d`` a degree and ``n`` a course name in lower case.
"""

# The first line that holds names the degree.
DEGREE_TAG = r"""CASE
 WHEN contains(t, 'b.tech') OR t IN ('be', 'b.e', 'be/b.e') THEN 'B.Tech'
 WHEN contains(t, 'm.tech') OR t IN ('me', 'm.e', 'me/m.e') THEN 'M.Tech'
 WHEN regexp_matches(t, 'mba|pgdm|pgp|post graduate program') THEN 'MBA'
 WHEN regexp_matches(t, 'b\.sc|bsc') THEN 'B.Sc'
 WHEN regexp_matches(t, 'm\.sc|msc') THEN 'M.Sc'
 WHEN contains(t, 'mbbs') THEN 'MBBS'
 WHEN contains(t, 'mca') THEN 'MCA'
 WHEN contains(t, 'bca') THEN 'BCA'
 WHEN regexp_matches(t, 'bba|bbm') THEN 'BBA'
 WHEN regexp_matches(t, 'b\.com|bcom') THEN 'B.Com'
 WHEN regexp_matches(t, '\bmpt\b') THEN 'MPT'
 WHEN regexp_matches(t, '\bbpt\b') THEN 'BPT'
 WHEN regexp_matches(t, '\bmot\b') THEN 'MOT'
 WHEN regexp_matches(t, '\bbot\b') THEN 'BOT'
 WHEN regexp_matches(t, '\bmch\b|m\.ch') THEN 'M.Ch'
 WHEN regexp_matches(t, '\bdm\b|d\.m\.') THEN 'DM'
 WHEN regexp_matches(t, '\bgnm\b|general nursing') THEN 'GNM'
 WHEN regexp_matches(t, '\bbaslp\b') THEN 'BASLP'
 WHEN regexp_matches(t, '\bbpo\b') THEN 'BPO'
 WHEN regexp_matches(t, '\boptom\b|b\.optom') THEN 'B.Optom'
 WHEN regexp_matches(t, '\bmph\b') THEN 'MPH'
 WHEN regexp_matches(t, '\bmha\b') THEN 'MHA'
 WHEN regexp_matches(t, '\bdnb\b') THEN 'DNB'
 WHEN regexp_matches(t, '\bfnb\b') THEN 'FNB'
 WHEN regexp_matches(t, '\bba\b|^b\.a\.') THEN 'BA'
 WHEN regexp_matches(t, '\bma\b|^m\.a\.') THEN 'MA'
 WHEN regexp_matches(t, 'ph\.d|phd|fpm') THEN 'Ph.D'
 WHEN regexp_matches(t, 'b\.des|bdes') THEN 'B.Des'
 WHEN regexp_matches(t, 'm\.des|mdes') THEN 'M.Des'
 WHEN contains(t, 'mpp') THEN 'MPP'
 WHEN contains(t, 'mds') THEN 'MDS'
 WHEN regexp_matches(t, '\bmd\b|m\.d\.') THEN 'MD'
 WHEN regexp_matches(t, '\bms\b|m\.s\.') THEN 'MS'
 WHEN contains(t, 'executive') THEN 'Executive Programme'
 ELSE trim(name) END"""

# Duration, level, exam and type by the first line that holds.
COURSE_DETAILS = r"""CASE
 WHEN regexp_matches(d, 'ph\.d|doctor|fpm|fellow') THEN ['3-5 Years', 'Doctorate', 'GATE / UGC NET', 'Full Time']
 WHEN regexp_matches(d, 'm\.tech|m\.e\.|^me$') THEN ['2 Years', 'PG', 'GATE', 'Full Time']
 WHEN regexp_matches(d, 'b\.tech|b\.e\.|^be$') THEN ['4 Years', 'UG', 'JEE Advanced', 'Full Time']
 WHEN regexp_matches(d, 'm\.sc|msc') THEN ['2 Years', 'PG', 'IIT JAM', 'Full Time']
 WHEN regexp_matches(d, 'b\.sc|bsc') THEN ['3 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN regexp_matches(d, 'mba|pgdm|pgp') THEN ['2 Years', 'PG', 'CAT', CASE WHEN regexp_matches(n, 'executive|emba|pgpx') THEN 'Part Time' ELSE 'Full Time' END]
 WHEN contains(d, 'mca') THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'bca') THEN ['3 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN regexp_matches(d, 'bba|bbm') THEN ['3 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'b.com') THEN ['3 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'b.des') THEN ['4 Years', 'UG', 'UCEED', 'Full Time']
 WHEN contains(d, 'm.des') THEN ['2 Years', 'PG', 'CEED', 'Full Time']
 WHEN contains(d, 'mbbs') THEN ['5 Years 6 Months', 'UG', 'NEET', 'Full Time']
 WHEN contains(d, 'md') OR d = 'ms' THEN ['3 Years', 'PG', 'NEET PG', 'Full Time']
 WHEN contains(d, 'mpt') THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'bpt') THEN ['4 Years 6 Months', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'mot') THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'bot') THEN ['4.5 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN regexp_matches(d, 'm\.ch|mch|dm') THEN ['3 Years', 'Doctorate', 'NEET SS', 'Full Time']
 WHEN contains(d, 'gnm') THEN ['3 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'baslp') THEN ['4 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'bpo') THEN ['4.5 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'optom') THEN ['4 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'mph') THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'mha') THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'dnb') THEN ['3 Years', 'PG', 'NEET PG', 'Full Time']
 WHEN contains(d, 'fnb') THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'b.a.') OR d = 'ba' THEN ['3 Years', 'UG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'm.a.') OR d = 'ma' THEN ['2 Years', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(d, 'llb') OR contains(n, 'law') THEN ['3-5 Years', 'UG', 'CLAT', 'Full Time']
 WHEN contains(d, 'llm') THEN ['1-2 Years', 'PG', 'CLAT PG', 'Full Time']
 WHEN contains(d, 'pgd') OR contains(n, 'diploma') THEN ['1 Year', 'PG', 'Not Specified', 'Full Time']
 WHEN contains(n, 'executive') THEN ['1 Year', 'PG', 'Not Specified', 'Part Time']
 ELSE ['Not Specified', 'UG', 'Not Specified', 'Full Time'] END"""

# Degrees that are postgraduate where no level is told.
PG_DEGREES = "('MBA', 'M.Tech', 'M.Sc', 'MCA', 'MA', 'M.Des', 'MPP', 'Ph.D', 'Executive Programme')"

# Words of fee lines, as whole words.
FEE_WORDS = (
    "fee|fees|charge|charges|chrage|chrages|stipend|deposit|expense|expenses|particulars|amount|living|refundable|hostel|utility|utilities|payment|gst|tax|caution|"
    "establishment|annual|academic year|stipend structure|indian students|saarc|non-saarc|international students|boys|girls|mess|electricity"
)

# First cells of header rows.
HEADER_CELLS = "('course', 'courses', 'm.tech specializations', 'b.tech specializations', 'm.sc specializations', 'm.tech courses', 'b.tech courses', 'm.sc courses')"

# Words in the first cell of a fee breakdown.
FEE_TABLE_WORDS = "particular|fee|stipend|expense|deposit|charge|chrage|breakdown|category|year|component|detail|cost"

# Table categories by heading ``h``.
TABLE_CATEGORY = """CASE WHEN contains(h, 'm.tech') AND contains(h, 'fees') THEN CASE WHEN contains(h, 'other') THEN 'M.Tech Courses' ELSE 'M.Tech Specializations' END
 WHEN contains(h, 'b.tech') AND contains(h, 'fees') THEN CASE WHEN contains(h, 'other') THEN 'B.Tech Courses' ELSE 'B.Tech Specializations' END
 WHEN contains(h, 'm.sc') AND contains(h, 'fees') THEN CASE WHEN contains(h, 'other') THEN 'M.Sc Courses' ELSE 'M.Sc Specializations' END
 WHEN contains(h, 'other courses') THEN 'Other Courses' WHEN contains(h, 'cep courses') THEN 'CEP Courses' ELSE 'Unknown' END"""
