"""Fixed code tables of the passage data providers, and the expressions that apply them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dam codes that report window counts.
DAMS = (
    "LWG", "WFF", "BON", "TDA", "JDA", "MCN", "IHR", "LMN", "LGS",
    "PRO", "ROZ", "PRD", "WAN", "RIS", "TUM", "RRH", "WEL", "ZOS",
)

# Window-count request code -> series name.
WINDOW_CODES = {
    "fc": "Chinook",
    "fk": "Coho",
    "fb": "Sockeye",
    "fs": "Steelhead",
    "fsw": "Wild_Steelhead",
    "fa": "Shad",
    "fcj": "Jack_Chinook",
    "fkj": "Jack_Coho",
    "fbj": "Jack_Sockeye",
    "fsj": "Jack_Steelhead",
    "fl": "Lamprey",
    "ft": "Bull_Trout",
}

# Parameter column of a window-count file -> series name.
WINDOW_PARAMETERS = {
    "Chin": "Chinook",
    "JChin": "Jack_Chinook",
    "Coho": "Coho",
    "JCoho": "Jack_Coho",
    "JStlhd": "Jack_Steelhead",
    "Lmpry": "Lamprey",
    "Shad": "Shad",
    "Sock": "Sockeye",
    "Stlhd": "Steelhead",
    "WStlhd": "Wild_Steelhead",
    "BTrout": "Bull_Trout",
}

# Tag database species code -> name.
TAG_SPECIES = {"1": "Chinook", "2": "Coho", "3": "Steelhead", "4": "Sockeye"}

# First digit of a species/run/rear code -> name.
TRAP_SPECIES = {
    "0": "Unknown",
    "1": "Chinook",
    "2": "Coho",
    "3": "Steelhead",
    "4": "Sockeye",
    "5": "Chum",
    "6": "Pink",
    "7": "Bull Trout",
    "8": "Cutthroat Trout",
    "9": "Other",
}

# Dam -> tag detection site.
DAM_TO_TAG_SITE = {"PRD": "PRA", "LWG": "GRA", "RIS": "RIA", "RRH": "RRF"}

# Dams without separate night counts.
DAMS_WITHOUT_NIGHT_COUNTS = ("PRD", "RIS", "RRH")

# Dam -> sites whose marked fish came through the dam's own trap.
TRAP_MARK_SITES = {"PRD": ("PRDLD1",), "LWG": ("LGRLDR", "LGR")}

# Dams whose trap rate rests on tags of the run's own species, whatever the trap holds and at any season.
OWN_SPECIES_DAMS = ("PRD",)

# Fixed values: (species, dam) -> first and last month-day of a run; a start after the end lies in the year before.
RUN_WINDOWS = {
    ("Steelhead", "LWG"): ("07-01", "06-30"),
    ("Steelhead", "PRD"): ("06-01", "05-31"),
    ("Chinook", "LWG"): ("03-01", "08-17"),
    ("Chinook", "PRD"): ("03-01", "06-15"),
}

COMPILED_SPECIES = ("Chinook", "Steelhead", "Coho")
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")


def translate(code: Column, table: dict[str, str], keep_unknown: bool = False) -> Column:
    """Look ``code`` up in a fixed table; unknown codes become NULL, or pass through."""
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    name = F.try_element_at(lookup, code)
    return F.coalesce(name, code) if keep_unknown else name


def species_of_srr(srr: Column) -> Column:
    return translate(F.substring(srr, 1, 1), TRAP_SPECIES)


def tag_site(dam: Column) -> Column:
    return translate(dam, DAM_TO_TAG_SITE)
