"""Tags, sizes, notes and labels: what a string on a sheet is taken for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide what a string is.
ONE_NUMBER = r"^[\s]*([0-9]+|[0-9]+/[0-9]+)[\s]*$"
SIZE_TIMES_SIZE = r"^([0-9]+|[0-9]+/[0-9]+)[\"|%|*]*[\s]*[xX][\s]*.*([0-9]+|[0-9]+/[0-9]+)[\"|%|*]*.*$"
ONE_SIZE = r"^([0-9]+|[0-9]+/[0-9]+)[\"%*]+$"
EQUIPMENT_TAG = r"^[A-Z]{1,5}[ -]?\d{1,5}[A-Z]?$"
TAG_PARTS = r"^([A-Z]{1,5})([ -]?)(\d+)([A-Z]?)$"
VALVE_TAG = r"^[A-Z]{1,3}[-\s]?\d{2,4}[A-Z]?$"
# Letters that a digit is misread for.
LOOKALIKES = {"0": "DOQ", "1": "ILT", "2": "Z", "5": "S", "6": "G", "8": "B"}
# First prefix of a label that fits gives its category.
CATEGORIES = (
    ("Equipment/", "equipment"),
    ("Instrument/Valve/", "valve"),
    ("Piping/Endpoint/Pagination", "pagination"),
    ("Piping/", "fitting"),
    ("Instrument/", "instrument"),
)
ARROW = "Piping/Fittings/Mid arrow flow direction"
PROMOTED = "Instrument/Valve/Gate valve NC"
# The characters that occur on a drawing.
CHARSET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" "0123456789" " .,:;-_/()[]%+*=<>#&@'\"°ØΦ"


def squeezed(text: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"^ | $", "")


def is_one_number(text: Column) -> Column:
    return text.rlike(ONE_NUMBER)


def has_letter_and_digit(text: Column) -> Column:
    """On the first line, as a full stop does not match a line's end."""
    first = F.split(text, "\n", 2)[0]
    return first.rlike("[a-zA-Z]") & first.rlike("[0-9]")


def is_size(text: Column) -> Column:
    return text.rlike(SIZE_TIMES_SIZE) | text.rlike(ONE_SIZE)


def is_equipment_tag(text: Column) -> Column:
    return squeezed(text).rlike(EQUIPMENT_TAG)


def tag_parts(text: Column) -> Column:
    """struct(head, sep, digits, suffix) of a string shaped like a tag, else null."""
    t = squeezed(text)
    part = lambda k: F.regexp_extract(t, TAG_PARTS, k)
    return F.when(t.rlike(TAG_PARTS), F.struct(part(1).alias("head"), part(2).alias("sep"), part(3).alias("digits"), part(4).alias("suffix")))


def repaired_tag(text: Column, width: Column, mapping: Column) -> Column:
    """A tag with one digit more than the sheet's width and no suffix ends in a misread letter; mapping: digit -> letter."""
    p = tag_parts(text)
    last = F.right(p["digits"], F.lit(1))
    letter = F.try_element_at(mapping, last)
    fits = p.isNotNull() & (width > 0) & (p["suffix"] == "") & (F.length(p["digits"]) == width + 1) & letter.isNotNull()
    return F.when(F.coalesce(fits, F.lit(False)), F.concat(p["head"], p["sep"], F.substring(p["digits"], F.lit(1), F.length(p["digits"]) - 1), letter)).otherwise(squeezed(text))


def looks_like_valve_tag(text: Column) -> Column:
    return F.coalesce(F.upper(F.trim(text)).rlike(VALVE_TAG), F.lit(False))


def promoted_label(label: Column, text: Column, long_side: Column, least: float = 18.0, rule: str = "either") -> Column:
    """An arrow that is a valve by its tag or its size (rule: tag, size, both or either) gets the valve's label."""
    tag, size = looks_like_valve_tag(text), long_side >= least
    hit = {"tag": tag, "size": size, "both": tag & size, "either": tag | size}[rule]
    return F.when((label == ARROW) & hit, F.lit(PROMOTED)).otherwise(label)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def is_prose(text: Column, symbol_distance: Column, words: int = 4, distance: float = 40.0) -> Column:
    """Many words or a numbered note, away from every symbol."""
    t = F.trim(text)
    numbered = F.regexp_replace(F.trim(F.substring(t, 1, 3)), r"\.+$", "").rlike(r"^[0-9]+$") & F.contains(F.substring(t, 1, 4), F.lit("."))
    return ((word_count(text) >= words) | numbered) & (symbol_distance > distance)


def compared_tag(text: Column) -> Column:
    """Upper case letters and digits alone; null if there are none."""
    return F.nullif(F.regexp_replace(F.upper(text), "[^A-Z0-9]", ""), F.lit(""))


def leaf(label: Column) -> Column:
    return F.element_at(F.split(label, "/"), -1)


def category(label: Column) -> Column:
    out = F.lit("other")
    for prefix, name in reversed(CATEGORIES):
        out = F.when(label.startswith(prefix), F.lit(name)).otherwise(out)
    return out


def starts_with_any(label: Column, prefixes: tuple[str, ...], fold_case: bool = False) -> Column:
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | (F.lower(label).startswith(p.lower()) if fold_case else label.startswith(p))
    return hit


def node_id(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), key.cast("string"))


def node_kind(node: Column) -> Column:
    k = F.split(node, "-")[0]
    return F.when(k == "l", F.lit("line")).when(k == "s", F.lit("symbol")).when(k == "t", F.lit("text")).otherwise(F.lit("unknown"))


def node_key(node: Column) -> Column:
    return F.element_at(F.split(node, "-"), -1).cast("long")


def listed(text: Column) -> Column:
    """The parts of a comma list, trimmed, without empty ones, each once."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))


def appended(existing: Column, text: Column) -> Column:
    return F.trim(F.concat_ws(" ", F.nullif(F.trim(existing), F.lit("")), text))


def display_name(text: Column, label: Column, key: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.concat(leaf(label), F.lit(" #"), key.cast("string")))


def restricted(text: Column, charset: str = CHARSET) -> Column:
    import re

    return F.regexp_replace(text, f"[^{re.escape(charset)}]", "")
