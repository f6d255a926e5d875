"""Ordered degree rules. Order is meaning: the first rule that holds wins."""

from __future__ import annotations

# Tags the table scan accepts as degrees.
RECOGNIZED_DEGREES = [
    "B.Tech", "M.Tech", "MBA", "B.Sc", "M.Sc", "MBBS", "MCA", "BCA", "BBA", "B.Com",
    "MPT", "BPT", "MOT", "BOT", "M.Ch", "DM", "GNM", "BASLP", "BPO", "B.Optom",
    "MPH", "MHA", "DNB", "FNB", "BA", "MA", "Ph.D", "B.Des", "M.Des", "MPP",
    "MDS", "MD", "MS", "Executive Programme",
]

# Fixed values: (tag, {kind of test: texts}).
# has = substring, word = whole word, eq = equality, starts = prefix, on lower-case text.
DEGREE_RULES = [
    ("B.Tech", {"has": ["b.tech", "be/b.tech"], "eq": ["be", "b.e", "be/b.e"]}),
    ("M.Tech", {"has": ["m.tech", "me/m.tech"], "eq": ["me", "m.e", "me/m.e"]}),
    ("MBA", {"has": ["mba", "pgdm", "pgpm", "pgpx", "pgp", "post graduate programme", "post graduate program"]}),
    ("B.Sc", {"has": ["b.sc", "bsc", "b.sc."]}),
    ("M.Sc", {"has": ["m.sc", "msc", "m.sc."]}),
    ("MBBS", {"has": ["mbbs"]}),
    ("MCA", {"has": ["mca"]}),
    ("BCA", {"has": ["bca"]}),
    ("BBA", {"has": ["bba", "bbm"]}),
    ("B.Com", {"has": ["b.com", "bcom"]}),
    ("MPT", {"word": ["mpt"]}),
    ("BPT", {"word": ["bpt"]}),
    ("MOT", {"word": ["mot"]}),
    ("BOT", {"word": ["bot"]}),
    ("M.Ch", {"word": ["mch"], "has": ["m.ch"]}),
    ("DM", {"word": ["dm"], "has": ["d.m."]}),
    ("GNM", {"word": ["gnm"], "has": ["general nursing"]}),
    ("BASLP", {"word": ["baslp"]}),
    ("BPO", {"word": ["bpo"]}),
    ("B.Optom", {"word": ["optom"], "has": ["b.optom"]}),
    ("MPH", {"word": ["mph"]}),
    ("MHA", {"word": ["mha"]}),
    ("DNB", {"word": ["dnb"]}),
    ("FNB", {"word": ["fnb"]}),
    ("BA", {"word": ["ba"], "starts": ["ba ", "b.a."], "eq": ["ba"]}),
    ("MA", {"word": ["ma"], "starts": ["ma ", "m.a."], "eq": ["ma"]}),
    ("Ph.D", {"has": ["ph.d", "phd", "fpm"]}),
    ("B.Des", {"has": ["b.des", "bdes"]}),
    ("M.Des", {"has": ["m.des", "mdes"]}),
    ("MPP", {"has": ["mpp"]}),
    ("MDS", {"has": ["mds"]}),
    ("MD", {"word": ["md"], "has": ["m.d."]}),
    ("MS", {"word": ["ms"], "has": ["m.s."]}),
    ("Executive Programme", {"has": ["executive"]}),
]

# Fixed values: (degree tests, course-name tests, duration, level, exam).
# None means the default of DETAIL_DEFAULTS.
DETAIL_RULES = [
    ({"has": ["ph.d", "doctor", "fpm", "fellow"]}, {}, "3-5 Years", "Doctorate", "GATE / UGC NET"),
    ({"has": ["m.tech", "m.e."], "eq": ["me"]}, {}, "2 Years", "PG", "GATE"),
    ({"has": ["b.tech", "b.e."], "eq": ["be"]}, {}, "4 Years", "UG", "JEE Advanced"),
    ({"has": ["m.sc", "msc"]}, {}, "2 Years", "PG", "IIT JAM"),
    ({"has": ["b.sc", "bsc"]}, {}, "3 Years", "UG", None),
    ({"has": ["mba", "pgdm", "pgpm", "pgp"]}, {}, "2 Years", "PG", "CAT"),
    ({"has": ["mca"]}, {}, "2 Years", "PG", None),
    ({"has": ["bca"]}, {}, "3 Years", "UG", None),
    ({"has": ["bba", "bbm"]}, {}, "3 Years", "UG", None),
    ({"has": ["b.com"]}, {}, "3 Years", "UG", None),
    ({"has": ["b.des"]}, {}, "4 Years", "UG", "UCEED"),
    ({"has": ["m.des"]}, {}, "2 Years", "PG", "CEED"),
    ({"has": ["mbbs"]}, {}, "5 Years 6 Months", "UG", "NEET"),
    ({"has": ["md", "mds"], "eq": ["ms"]}, {}, "3 Years", "PG", "NEET PG"),
    ({"has": ["mpt"]}, {}, "2 Years", "PG", None),
    ({"has": ["bpt"]}, {}, "4 Years 6 Months", "UG", None),
    ({"has": ["mot"]}, {}, "2 Years", "PG", None),
    ({"has": ["bot"]}, {}, "4.5 Years", "UG", None),
    ({"has": ["m.ch", "mch"]}, {}, "3 Years", "Doctorate", "NEET SS"),
    ({"has": ["dm"]}, {}, "3 Years", "Doctorate", "NEET SS"),
    ({"has": ["gnm"]}, {}, "3 Years", "UG", None),
    ({"has": ["baslp"]}, {}, "4 Years", "UG", None),
    ({"has": ["bpo"]}, {}, "4.5 Years", "UG", None),
    ({"has": ["b.optom", "optom"]}, {}, "4 Years", "UG", None),
    ({"has": ["mph"]}, {}, "2 Years", "PG", None),
    ({"has": ["mha"]}, {}, "2 Years", "PG", None),
    ({"has": ["dnb"]}, {}, "3 Years", "PG", "NEET PG"),
    ({"has": ["fnb"]}, {}, "2 Years", "PG", None),
    ({"has": ["b.a."], "eq": ["ba"]}, {}, "3 Years", "UG", None),
    ({"has": ["m.a."], "eq": ["ma"]}, {}, "2 Years", "PG", None),
    ({"has": ["llb"]}, {"has": ["law"]}, "3-5 Years", "UG", "CLAT"),
    ({"has": ["llm"]}, {}, "1-2 Years", "PG", "CLAT PG"),
    ({"has": ["pgd"]}, {"has": ["diploma"]}, "1 Year", "PG", None),
    ({}, {"has": ["executive"]}, "1 Year", "PG", None),
]

# Rules (numbered from 0) under which these course names are part time.
PART_TIME_NAMES = {
    5: ["executive", "emba", "pgpx"],
    33: ["executive"],
}

# What holds when no rule does.
DETAIL_DEFAULTS = {
    "duration": "Not Specified",
    "course_level": "UG",
    "entrance_exam": "Not Specified",
    "course_type": "Full Time",
}

# Course level from level text, in order; then from the degree.
LEVEL_WORDS = [
    ("Doctorate", ["doctor"]),
    ("PG", ["post", "pg", "master"]),
    ("UG", ["graduation", "undergraduate", "ug"]),
    ("PG", ["certificate", "diploma"]),
]
PG_DEGREES = ["MBA", "M.Tech", "M.Sc", "MCA", "MA", "M.Des", "MPP", "Ph.D", "Executive Programme"]

# Table headings that name the degree of every row, as
# (degree word in heading, degree, duration, level, exam).
HEADED_DEGREES = [
    ("m.tech", "M.Tech", "2 Years", "PG", "GATE"),
    ("b.tech", "B.Tech", "4 Years", "UG", "JEE Advanced"),
    ("m.sc", "M.Sc", "2 Years", "PG", "IIT JAM"),
]

# Rows of an "other courses" table, as (degree words, duration, level, exam).
OTHER_COURSE_RULES = [
    (["ph.d", "doctor"], "3-5 Years", "Doctorate", "GATE / UGC NET"),
    (["b.des"], "4 Years", "UG", "UCEED"),
    (["m.des"], "2 Years", "PG", "CEED"),
    (["mba", "emba"], "2 Years", "PG", "CAT"),
    (["mpp"], "2 Years", "PG", "Not Specified"),
    (["executive"], "1 Year", "PG", "Not Specified"),
]

# Rows added under an "other courses" table when asked for, as
# (degree, specialization, fee or None for the fee of the row, duration, eligibility, exam, level).
EXPANDED_ROWS = [
    ("MBA", "General", None, "2 Years", "Graduation with 60%+", "CAT", "PG"),
    ("MBA", "Telecommunication Systems Management", None, "2 Years", "Graduation with 60%+", "CAT", "PG"),
    ("Ph.D", "Artificial Intelligence", "3.4 Lakhs", "3-5 Years", "Postgraduation in relevant field", "GATE / UGC NET", "Doctorate"),
    ("Ph.D", "Information Technology", "3.4 Lakhs", "3-5 Years", "Postgraduation in relevant field", "GATE / UGC NET", "Doctorate"),
    ("Ph.D", "Humanities And Social Science", "3.4 Lakhs", "3-5 Years", "Postgraduation in relevant field", "GATE / UGC NET", "Doctorate"),
    ("Ph.D", "Public Policy", "3.4 Lakhs", "3-5 Years", "Postgraduation in relevant field", "GATE / UGC NET", "Doctorate"),
]
