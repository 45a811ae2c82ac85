"""Lookup tables that must hold the same values as the analyses they mirror.

FIXED VALUES.  Every table below is a fixed value list: the words, codes and
ranks are what the results depend on, written out in their natural order.
They are turned into Spark ``create_map`` literals or ordered ``when``
chains by ``tenurekit.functions.clean``; nothing here touches data.
"""

from __future__ import annotations

# --- FIXED VALUES: role aliases (lower-cased input -> standard role) -------
ROLE_ALIASES = {
    "top": "Top", "toplane": "Top",
    "jungle": "Jungle", "jng": "Jungle", "jungler": "Jungle", "jg": "Jungle",
    "mid": "Mid", "middle": "Mid", "midlane": "Mid",
    "adc": "ADC", "bot": "ADC", "ad carry": "ADC", "marksman": "ADC", "bottom": "ADC",
    "support": "Support", "sup": "Support", "supp": "Support",
}
# The workbook variant of the role map lacks these two aliases.
ROLE_ALIASES_WORKBOOK_MISSING = ("jg", "bottom")

# --- FIXED VALUES: country name -> ISO-3166 alpha-2 ------------------------
COUNTRY_CODES = {
    "South Korea": "KR", "Korea": "KR", "Republic of Korea": "KR",
    "China": "CN", "People's Republic of China": "CN",
    "United States": "US", "USA": "US", "United States of America": "US",
    "Denmark": "DK", "Sweden": "SE", "Germany": "DE", "France": "FR",
    "Poland": "PL", "Spain": "ES", "Belgium": "BE", "Slovenia": "SI",
    "Taiwan": "TW", "Vietnam": "VN", "Japan": "JP", "Philippines": "PH",
    "Brazil": "BR", "Argentina": "AR", "Mexico": "MX", "Chile": "CL",
    "Canada": "CA", "Australia": "AU", "New Zealand": "NZ",
    "United Kingdom": "GB", "Russia": "RU", "Turkey": "TR",
    "Netherlands": "NL", "Czech Republic": "CZ", "Czechia": "CZ",
    "Croatia": "HR", "Bulgaria": "BG", "Romania": "RO", "Hungary": "HU",
    "Norway": "NO", "Finland": "FI", "Greece": "GR", "Portugal": "PT",
    "Hong Kong": "HK", "Singapore": "SG", "Malaysia": "MY",
    "Thailand": "TH", "Indonesia": "ID",
}

# --- FIXED VALUES: league name -> region (season-file variant) -------------
LEAGUE_REGION = {
    "LCK": "LCK", "LPL": "LPL", "LEC": "LEC", "LCS": "LCS",
    "PCS": "PCS", "VCS": "VCS", "CBLOL": "CBLOL", "LJL": "LJL",
    "LLA": "LLA", "TCL": "TCL", "LCO": "LCO",
    "NA LCS": "LCS", "EU LCS": "LEC", "OGN": "LCK", "GPL": "PCS",
    "LMS": "PCS", "CBLoL": "CBLOL", "NALCS": "LCS", "EULCS": "LEC",
    "Brazil": "CBLOL", "Vietnam": "VCS",
    "Latin America": "LLA", "LAN": "LLA", "LAS": "LLA",
    "LCK CL": "LCK", "LDL": "LPL", "EUM": "LEC", "LTAN": "LCS",
    "NLC": "LEC", "LFL": "LEC", "PRM": "LEC", "SL": "LEC",
}
# The workbook variant knows only the first 17 entries above (through "CBLoL").
LEAGUE_REGION_WORKBOOK_KEYS = (
    "LCK", "LPL", "LEC", "LCS", "PCS", "VCS", "CBLOL", "LJL", "LLA", "TCL", "LCO",
    "NA LCS", "EU LCS", "OGN", "GPL", "LMS", "CBLoL",
)

# --- FIXED VALUES: roster tier letter -> numeric tier (default 2) ----------
TIER_LETTER = {"S": 1, "A": 2, "B": 2, "s": 1, "a": 2, "b": 2}

# --- FIXED VALUES: tournament level -> tier letter, and tier rank order ----
TOURNAMENT_LEVEL_TIER = {
    "S": "S", "A": "A", "B": "B", "C": "C", "D": "D",
    "Primary": "S", "Secondary": "A", "Tertiary": "B",
    "Showmatch": "D", "Qualifier": "C",
}
TIER_ORDER = ["S", "A", "B", "C", "D", "?"]

# --- FIXED VALUES: split name substring -> sort rank (first match wins) ----
SPLIT_ORDER = [
    ("Play-In", 5),
    ("Spring", 10),
    ("Summer", 20),
    ("Split 1", 15),
    ("Split 2", 25),
    ("Winter", 8),
    ("Fall", 30),
    ("Playoffs", 40),
    ("Showmatch", 50),
    ("Qualifier", 3),
]
SPLIT_RANK_NULL = 100
SPLIT_RANK_OTHER = 35

# --- FIXED VALUES: league-name keywords -> league code (first match wins) --
# "full" list (team scan variant)
LEAGUE_KEYWORDS_FULL = [
    ("LoL Champions Korea", "LCK"),
    ("Challengers Korea", "LCK"),
    ("KeSPA", "LCK"),
    ("Tencent LoL Pro League", "LPL"),
    ("LPL", "LPL"),
    ("LoL EMEA Championship", "LEC"),
    ("Europe League Championship Series", "LEC"),
    ("LEC", "LEC"),
    ("League Championship Series", "LCS"),
    ("LCS", "LCS"),
    ("North American", "LCS"),
    ("NA LCS", "LCS"),
    ("Pacific Championship Series", "PCS"),
    ("LoL Master Series", "LMS"),
    ("LMS", "LMS"),
    ("Turkish Championship League", "TCL"),
    ("TCL", "TCL"),
    ("Vietnam Championship Series", "VCS"),
    ("CBLOL", "CBLOL"),
    ("Latin America", "LLA"),
    ("LLA", "LLA"),
    ("Oceanic", "OCE"),
    ("OPL", "OCE"),
]
# "fast" list (scoreboard variant): different order, adds VCS
LEAGUE_KEYWORDS_FAST = [
    ("LoL Champions Korea", "LCK"), ("Challengers Korea", "LCK"), ("KeSPA", "LCK"),
    ("Tencent LoL Pro League", "LPL"), ("LPL", "LPL"),
    ("LoL EMEA Championship", "LEC"), ("Europe League Championship Series", "LEC"), ("LEC", "LEC"),
    ("League Championship Series", "LCS"), ("NA LCS", "LCS"), ("North American", "LCS"), ("LCS", "LCS"),
    ("Pacific Championship Series", "PCS"), ("LoL Master Series", "LMS"), ("LMS", "LMS"),
    ("Turkish Championship League", "TCL"), ("TCL", "TCL"),
    ("Vietnam Championship Series", "VCS"), ("VCS", "VCS"),
    ("CBLOL", "CBLOL"), ("Latin America", "LLA"), ("LLA", "LLA"),
    ("Oceanic", "OCE"), ("OPL", "OCE"),
]
# region name -> league code, used when no keyword matches
REGION_LEAGUE = {
    "Korea": "LCK", "China": "LPL", "Europe": "LEC", "EMEA": "LEC",
    "North America": "LCS", "NA": "LCS", "SEA": "PCS", "Asia": "PCS",
    "Turkey": "TCL", "International": "INT", "Oceania": "OCE",
    "Brazil": "CBLOL", "Vietnam": "VCS", "Latin America": "LLA",
}

# --- FIXED VALUES: competitive season numbering ----------------------------
# Season n is calendar year 2010 + n; labelled seasons run S6 (2016) .. S15 (2025).
SEASON_YEAR_BASE = 2010
SEASON_FIRST_LABELLED = 6
SEASON_LAST_LABELLED = 15

# --- FIXED VALUES: report orderings ----------------------------------------
ROLE_REPORT_ORDER = ["Top", "Jungle", "Mid", "Bot", "ADC", "Support", "(unknown)"]
VOLATILITY_ORDER = ["Stable (0-1 changes)", "Moderate (2 changes)", "High (3+ changes)"]
# East = LCK + LPL, West = LEC + LCS, everything else Other
EAST_LEAGUES = ["LCK", "LPL"]
WEST_LEAGUES = ["LEC", "LCS"]

# --- FIXED VALUES: scoring service vocabulary ------------------------------
VALID_LEAGUES = ["LCK", "LPL", "LEC", "LCS"]
VALID_ROLES = ["Top", "Jungle", "Mid", "Bot", "Support"]
REFERENCE_LEAGUE = "LCS"
REFERENCE_ROLE = "Top"
