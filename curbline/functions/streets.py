"""Street names: abbreviation and case."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Types of streets that are shortened wherever they stand behind a blank: fixed values.
TYPES = {"Drive": "Dr", "Street": "St", "Road": "Rd", "Boulevard": "Blvd", "Parkway": "Pkwy", "Place": "Pl", "Square": "Sq", "Circle": "Crcl", "Trail": "Trl", "Grove": "Grv"}
#: Types that are names too: shortened only behind a capitalised word, and not before another one. Fixed values.
NAMES = {"Court": "Crt", "Avenue": "Ave", "Crescent": "Cres", "Terrace": "Ter", "Gardens": "Gdns", "Heights": "Hts", "Mount": "Mt", "Circuit": "Crct", "Park": "Pk"}
#: Directions, under the same condition; types that are shortened anywhere; what comes out wrong by these rules. Fixed values.
DIRECTIONS = {"East": "E", "West": "W", "North": "N", "South": "S"}
ANYWHERE = {"Gate": "Gt", "Pathway": "Pthwy"}
WRONG = {" Grv Rd": " Grove Rd", " Grv Ave": " Grove Ave", "Rd Cres": "Road Cres"}
#: Types and directions that may also come in small letters.
SMALL = {"Court", "Avenue", "Crescent", "Terrace", "Gardens", *DIRECTIONS}
#: Words that stay small in a description, before a blank or between blanks; words for a quarter of the compass. Fixed values.
BEFORE, BETWEEN = ["From", "To", "And", "Of"], ["A", "Point", "Between", "Thereof", "The"]
QUARTERS = [("north", "west"), ("north", "east"), ("south", "east"), ("south", "west")]


def abbreviate(name: Column) -> Column:
    """Shortens the types of streets and directions in a text; remarks in brackets go, metres become m."""
    out = F.regexp_replace(name, "[\\t\\x0B\\x08\\r\\n\\u00a0]", " ")
    for word, short in (NAMES | DIRECTIONS).items():
        first = f"[{word[0]}{word[0].lower()}]" if word in SMALL else word[0]
        out = F.regexp_replace(out, rf"(?<=[A-Z][a-z]{{1,40}} ){first}{word[1:]}(?![a-z])(?! [A-Z])", short)
    for word, short in TYPES.items():
        out = F.regexp_replace(out, f" {word}", f" {short}")
    for short in DIRECTIONS.values():
        out = F.regexp_replace(out, f" Avenue {short}", f" Ave {short}")
    for word, short in ANYWHERE.items():
        out = F.regexp_replace(out, word, short)
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(out, "(?i)metres", "m"), r"\([^(]+\)", ""), "(?i)approximately", "")
    for wrong, right in WRONG.items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def capitals(name: Column) -> Column:
    """Initial capitals, also behind hyphens, slashes and apostrophes."""
    return F.array_join(F.transform(F.split(F.lower(name), r"(?<=[^\p{L}\p{N}])"), F.initcap), "")


def title_case(name: Column) -> Column:
    """A description's words with initial capitals but for small words; metres become m, and pairs of directions one word."""
    out = capitals(name)
    for word in BEFORE:
        out = F.replace(out, F.lit(f"{word} "), F.lit(f"{word.lower()} "))
    for word in BETWEEN:
        out = F.replace(out, F.lit(f" {word} "), F.lit(f" {word.lower()} "))
    out = F.regexp_replace(out, " (?:Metres|M) ", " m ")
    for a, b in QUARTERS:
        out = F.regexp_replace(out, f"(?i) (?:{a}[/ ]{b}|{b}/{a}) ", f" {(a + b).capitalize()} ")
    return out
