"""Goal documents: XML text of one match, one ``value`` element per goal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.schemas import ABSENT, OPEN_PLAY, OWN_GOAL, PENALTY_IN_PLAY, SHOOT_OUT, UNKNOWN_TYPE

CORRUPT = "_corrupt_record"

# The tags of a goal that are read.
GOALS = (
    "ARRAY<STRUCT<id STRING, player1 STRING, subtype STRING, "
    "stats STRUCT<goals STRING, shoton STRING, penalty STRING, penalties STRING, owngoals STRING>>>"
)
# The parser reads one element and stops, so the text is wrapped in an outer one: a second root, or text beside the
# root, then shows.
OUTER = "touchline-document"
DOCUMENT = f"goal ARRAY<STRUCT<value {GOALS}>>, _VALUE STRING, {CORRUPT} STRING"

# A byte-order mark and a declaration, which can't stand inside an element. A document type is not read and rejected.
PROLOGUE = r"^\x{FEFF}?\s*(<\?xml[^>]*\?>)?"


def parse_document(xml: Column) -> Column:
    """Parse inside the JVM; text that is no XML comes back in the corrupt-record field. Blanks in values stay."""
    # text that starts with an element has no prologue
    bare = xml.startswith("<") & ~xml.startswith("<?")
    element = F.when(bare, xml).otherwise(F.regexp_replace(xml, PROLOGUE, ""))
    wrapped = F.concat(F.lit(f"<{OUTER}>"), element, F.lit(f"</{OUTER}>"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreSurroundingSpaces": "false"}
    return F.from_xml(wrapped, DOCUMENT, options)


def goals_of(parsed: Column) -> Column:
    return parsed["goal"][0]["value"]


def _unreadable(number: Column) -> Column:
    return (F.trim(number) != "") & number.try_cast("bigint").isNull()


def is_malformed(xml: Column, parsed: Column, numbered_players: bool = True) -> Column:
    """Anything but one ``goal`` element with nothing beside it, or a goal's id that is no number; with
    ``numbered_players`` a player's too."""
    roots = F.coalesce(F.size(parsed["goal"]), F.lit(-1))
    beside = F.coalesce(F.regexp_replace(parsed["_VALUE"], r"\s", ""), F.lit("")) != ""
    fields = ("id", "player1") if numbered_players else ("id",)
    lost = [lambda g, f=f: F.coalesce(_unreadable(g[f]), F.lit(False)) for f in fields]
    ids = F.exists(goals_of(parsed), lambda g: reduce(lambda x, y: x | y, (test(g) for test in lost)))
    bad = parsed[CORRUPT].isNotNull() | (roots != 1) | beside | F.coalesce(ids, F.lit(False)) | xml.contains(OUTER)
    return xml.isNotNull() & bad


def goal_type(stats: Column) -> Column:
    """Type of a goal by which tags its statistics hold; the tags' values do not matter."""

    def has(tag: str) -> Column:
        return stats[tag].isNotNull()

    return (
        F.when(stats.isNull(), ABSENT)
        .when(has("goals") & has("shoton"), OPEN_PLAY)
        .when(has("goals") & has("penalty"), PENALTY_IN_PLAY)
        .when(has("penalties"), SHOOT_OUT)
        .when(has("owngoals"), OWN_GOAL)
        .otherwise(UNKNOWN_TYPE)
    )


def goal_subtype(subtype: Column) -> Column:
    """A dash where the tag is absent, nothing where it is empty."""
    return F.when(subtype.isNull(), ABSENT).when(subtype != "", subtype)
