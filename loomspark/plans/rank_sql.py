"""The rule tables once more, for the checking database: each line is points and pattern. They are written apart from the operators' tables, so that a wrong rule there shows."""

from __future__ import annotations


def sql_match(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '(?i){pattern.replace(chr(39), chr(39) * 2)}')"


def sql_sum(text: str, table: str) -> str:
    lines = [line.split(" ", 1) for line in table.strip().splitlines()]
    return "(" + " + ".join(f"CASE WHEN {sql_match(text, pattern)} THEN {points} ELSE 0 END" for points, pattern in lines) + ")"


# Points and patterns.
LINK_TEXT = r"""
10 annual\s+(?:and\s+sustainability\s+)?report
10 årsredovisning
8 års-?\s*och\s+hållbarhetsredovisning
3 \bannual\b
"""
LINK_BOTH = r"""
-10 \bq[1-4]\b
-10 \binterim\b
-10 \bquarterly\b
-10 delårsrapport
-8 \bgovernance\b
-8 \bremuneration\b
-8 \bpresentation\b
-32 \bacq[u]?isition\b|acquisition[-_\s]present|\bpresentations\/[^?\s]*acqui|\b(?:m&a|mergers?\s+and\s+acquisitions?)\b[^\n]{0,80}\bpresentation\b
-8 capital\s*markets?\s*day
-10 \bpress\s*release\b
-8 \bnews\b
-12 \bgeneral\s*meeting\b
-18 \bannual\s+general\s+meeting\b
-18 \bextraordinary\s+general\b
-14 \bagm\b
-14 \bproxy\b
-22 \bvoting\b
-22 \bpostal[\s-]*voting\b
-18 \bpost[\s-]*vote\b
-22 \bkallelse\b
-16 \bstämma\b
-22 \bbolagsstämma\b
-20 \bbolagsstamma\b
-20 \bröstmaterial\b
-12 \bvalberedning
-18 \bnotice\s+of\s+(?:the\s+)?(?:annual|general|egm)\b
-16 \binstructions\s+for\s+(?:voting|shareholders)\b
-3 \bsummary\b
-3 \bsammandrag\b
-22 \byear\s+in\s+brief\b
-10 \bhighlights?\b
-8 \bholdings?\b
-14 \bsustainability\s+report\b
-14 \bhållbarhetsrapport\b
-14 \bhållbarhetsredovisning\b
-3 \besef\b
-5 \bcopy[\s-]+of[\s-]+the[\s-]+official\b
-24 \bpillar[\s-]*3\b
-20 \brisk\s+disclosures?\b
-16 \brisk\s+report\b
-24 \bnomination\s+committee'?s?\b
-24 \bboard\s+proposal\b
-16 \blti\b
-18 \bremuneration\s+report\b
-26 bolagsstyrningsrapport
-26 corporate\s+governance\s+report
-20 \bpolicy\b
-20 \bfact\s*book\b
-24 \bgovernance\s+statement\b
"""
ADDRESS = r"""
5 \.pdf(\?|$)
4 annual|arsredovisning|årsredovisning
3 annual-and-sustainability|annual.report|arsredovisning|års-och-hållbarhets
-38 \bacq[u]?isition\b|acquisition[-_\s]present|\bpresentations\/[^?\s]*acqui|\b(?:m&a|mergers?\s+and\s+acquisitions?)[-_\s]
-10 press|\/pr-|\/news\/|pressrelease|_pr_
-8 interim|quarterly|q[1-4]\b
-22 voting|postal[\s-]*vote|kallelse|proxy|bolagsst(a|ä)mma|röstmaterial|\/agm\b|_agm_|instruktioner
-22 nomination|board-proposal|board-proposals|lti-|remuneration-report
-28 corpgov|bolagsstyrn|corp[-_]gov|governance[-_]report
-18 policy|factbook|presentation|remuneration[-_]report
"""
ANNUAL_CLASS = r"\b(annual\s+(and\s+sustainability\s+)?report|integrated\s+annual\s+report|annual\s+financial\s+report)\b|årsredovisning"
OTHER_CLASS = r"\b(corporate\s+governance|governance\s+report|governance\s+statement|policy|presentation|factbook|year\s+in\s+brief|remuneration\s+report|annual\s+general\s+meeting|agm|notice\s+of\s+meeting|sustainability\s+report|hållbarhetsrapport|hållbarhetsredovisning|acq[u]?isition)\b"
BROWSER_TEXT = r"""
10 annual\s+(?:and\s+sustainability\s+)?report
10 årsredovisning
-10 Q[1-4]
-10 interim|quarterly|delårsrapport
-8 governance|remuneration|presentation
-8 press\s*release|news
-3 summary|sammandrag
"""
BROWSER_ADDRESS = r"""
4 annual|arsredovisning|årsredovisning
3 annual-and-sustainability|annual.report|arsredovisning|årsredovisning
-8 press|\/pr-|\/news\/|pressrelease
"""
BROWSER_BOTH = r"""
-22 voting|postal[\s-]*voting|postal[\s-]*vote|kallelse|bolagsst(a|ä)mma|stämma|röstmaterial|notice\s+of\s+(?:the\s+)?(?:annual|general)
-14 \bagm\b
-14 \bproxy\b
"""
WIRE = r"""
8 annual\s*(?:and\s*sustainability)?\s*report|arsredovisning|årsredovisning|annual-report
-10 press|\/pr-|\/news\/|pressrelease|_pr_
-10 interim|quarterly|q[1-4]
-6 governance|remuneration|presentation
-22 voting|kallelse|proxy|bolagsst(a|ä)mma|stämma|röstmaterial|\bagm\b|postal
"""
CMS = r"""
10 annual\s+(and\s+sustainability\s+)?report|årsredovisning|arsredovisning
-12 q[1-4]\b|quarterly|interim|delårsrapport
-16 governance|bolagsstyrning|remuneration|nomination|board\s+proposal
"""
AGGREGATOR = r"""
10 annual\s+(and\s+sustainability\s+)?report|årsredovisning|arsredovisning
-12 q[1-4]\b|quarterly|interim|delårsrapport
-14 governance|bolagsstyrning|remuneration|nomination
"""
SEARCH_TEXT = r"""
10 annual\s*(?:and\s*sustainability\s*)?\s*report
10 årsredovisning
-10 interim|quarterly|q[1-4]
-8 governance|remuneration
-22 voting|postal[\s-]*voting|postal[\s-]*vote|kallelse|bolagsst(a|ä)mma|stämma|röstmaterial|notice\s+of\s+(?:the\s+)?(?:annual|general)
-14 \bagm\b|\bproxy\b
-3 summary|sammandrag
"""
SEARCH_ADDRESS = r"""
6 annual.report|arsredovisning|årsredovisning
-10 press|pressrelease|\/news\/
-22 voting|kallelse|proxy|bolagsst(a|ä)mma|stämma|röstmaterial|\bagm\b|postal
"""
IR_TEXT = r"""
10 investor\s*relations
8 ^investors$
8 investerare
6 investor
5 financial\s*reports
5 årsredovisning
4 annual\s*report
3 \breports\b
-5 calendar
-5 contact
-5 governance
-5 press
-5 news
-5 career
-10 cookie
-10 privacy
-10 legal
"""
IR_ADDRESS = r"""
5 /investor
4 /ir/
3 /reports
2 /en/
"""
