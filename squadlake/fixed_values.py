"""The data contract of the squad lake.

Labels, thresholds, floors and table names that readers of the tables rely on.
They are kept together here, spelled exactly as the data spells them.
"""

# --- fixed values: labels -------------------------------------------------
NO_NATIONALITY = "None"
NO_CLUB = "No team"
NO_ORIGIN = "None"
DEFAULT_STATUS = "available to play"
AVAILABLE = "Available to play"
INJURED = "Injuried"
AVAILABLE_STATUSES = ("team captain", "available to play")

# --- fixed values: market value text --------------------------------------
CURRENCY_SIGN = "€"
# All characters whose lower case is k or m; \u212a is the Kelvin sign.
THOUSAND_MARKS = "kK\u212a"
MILLION_MARKS = "mM"

# --- fixed values: team names ---------------------------------------------
CLUB_TOKEN = "FC"
CLUB_SUBSTRINGS = ("_FC", "FC_", "FC")

# --- fixed values: age bands (label, lowest age, highest age), both inclusive
AGE_BANDS = (
    ("Under 20", None, 19),
    ("20-23", 20, 23),
    ("24-27", 24, 27),
    ("28-31", 28, 31),
)
OLDEST_BAND = "Over 31"

# --- fixed values: gold parameters ----------------------------------------
MARKET_FLOOR = 2010
SQUAD_AGE_FLOOR = 2005
SEASON_TOP = 10
OVERALL_TOP = 15

# --- fixed values: white space stripped at the ends of a text --------------
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f \u0085\u00a0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
