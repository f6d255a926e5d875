"""Rankings in text: one search for mentions gives what a search per pattern and alias gives."""

import random
import re

from campusweave.plans import rankings
from campusweave.rules import patterns as P
from campusweave.site import Site

WORDS = ["ranked", "Ranked", "12th", "7", "rank", "Rank", "#", "#4", "by", "NIRF", "nirf", "QS World", "QS World University", "QS India", "The Week", "Outlook", "2023", "20", "19999", "6001", "in", "x" * 30, ".", ". ", ",", "12.5", "Campus Guide", "٣", "\n"]


def searched(text, site):
    """Every pattern of every alias on the whole text."""
    out = []
    for body, aliases in rankings.bodies(site):
        for alias in aliases:
            if alias.lower() not in text.lower():
                continue
            found = [re.search(p.replace("(?iU)", "(?i)").replace("<alias>", re.escape(alias)), text) for p in P.RANK_PATTERNS]
            hit = next((m for m in found if m), None)
            if hit and hit[1].isascii() and int(hit[1]) <= 5000:
                year = int(hit[2]) if hit[2] else None
                out.append((body, hit[1], year if year and 2000 <= year <= 2030 else None))
                break
    return out


def test_mentions_give_what_whole_texts_give(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    texts += ["", ".", "NIRF", "ranked 5 by NIRF", "ranked 5 by NIRF. In. all 2024 of", "NIRF rank 3" + "." * 50 + "2021", "ranked 1. NIRF", "x" * 50_000 + " ranked 8 by Outlook " + "y" * 50_000 + "2022"]
    for site in (Site(), Site(brand="Guide.com", rank_label="G")):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, main_text string")
        got = {r["i"]: [(x["ranking_body"], x["rank"].rsplit("#", 1)[1], x["ranking_year"]) for x in r["r"]] for r in df.select("i", rankings.text_rankings("main_text", site).alias("r")).collect()}
        for i, text in enumerate(texts):
            assert got[i] == searched(text, site), text
