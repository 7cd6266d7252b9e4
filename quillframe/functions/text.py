"""Column functions on text: normalisation, markers, labels, locators, lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillframe.functions.dialect import SPACES, portable

SUB_OPEN, SUB_CLOSE = "\ue000", "\ue001"
RAISED, LOWERED = "^", "_"


def collapse_ws(text: Column) -> Column:
    """Each run of white space, no-break spaces included, as one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACES}]+", " "))


def strip_format(text: Column, control: bool = False) -> Column:
    """Without format characters (zero-width and the like); ``control``: nor control characters."""
    return F.regexp_replace(text, r"[\p{Cf}\p{Cc}]" if control else r"\p{Cf}", "")


def format_chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\p{Cf})"), 1)


def expand_subscripts(text: Column) -> Column:
    """What follows ``_`` or ``^`` (braces, a run of digits and dots, or one character) between two marks; the sign goes."""
    return F.regexp_replace(text, r"[_^](?:\{([^}]*)\}|(\p{Nd}[\p{Nd}.]*)|([^\n]))", f"{SUB_OPEN}$1$2$3{SUB_CLOSE}")


def sentinel_split(text: Column) -> Column:
    """Pieces between marks; those at odd places were marked."""
    return F.split(text, f"[{SUB_OPEN}{SUB_CLOSE}]")


#: A dashed arrow, with its condition in it or none, or a bare one.
ARROW = "——+[^—→+]{0,40}→|——+>?|--+>|→|⟶|=+>"
_CUT = "\ue002"


def typed_segments(text: Column) -> Column:
    """Pieces (kind, text) of a line: arrows first, then what stands between marks, then the rest; empty ones are left out."""
    piece = lambda kind, x: F.struct(kind.alias("kind"), x.alias("text"))
    words = lambda x: F.transform(sentinel_split(x), lambda y, j: piece(F.when(j % 2 == 1, "marked").otherwise("plain"), y))
    parts = F.split(F.regexp_replace(text, f"({ARROW})", f"{_CUT}$1{_CUT}"), _CUT)
    typed = F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.array(piece(F.lit("arrow"), x))).otherwise(words(x)))
    return F.filter(F.flatten(typed), lambda p: p["text"] != "")


def literal_split(text: Column, chars: str) -> Column:
    """Pieces of ``text`` with each of ``chars`` a piece of its own."""
    return F.filter(F.split(F.regexp_replace(text, f"([{chars}])", f"{SUB_OPEN}$1{SUB_OPEN}"), SUB_OPEN), lambda x: x != "")


def marker_ordinal(text: Column) -> Column:
    """The printed number at the start of a line: digits, A to H as 1 to 8, circled 1 to 20; else null."""
    digits = F.regexp_extract(text, portable(r"^\s*([0-9]{1,4})\s*[.．、)）]"), 1)
    letter = F.regexp_extract(text, portable(r"^\s*([A-H])\s*[.．、)）]"), 1)
    circled = F.regexp_extract(text, portable(r"^\s*([①-⑳])"), 1)
    return F.when(digits != "", digits.cast("int")).when(letter != "", F.ascii(letter) - 64).when(circled != "", F.ascii(circled) - 9311)


def strip_marker(text: Column) -> Column:
    """Without a leading number marker of at most twelve characters; never across a blank to fill in."""
    head = portable(r"^\s*(?:[0-9]{1,4}|[A-H])\s*[.．、)）]\s*")
    return F.when(F.length(F.regexp_extract(text, f"({head})", 1)) <= 12, F.regexp_replace(text, head, "")).otherwise(text)


def strip_marker_runs(runs: Column) -> Column:
    """Runs (structs with text) without a leading marker of at most twelve characters, which may lie across several of them.

    A run of underscores or of blanks to fill in is never part of a marker; what is left of a run keeps its marks.
    """
    whole = F.array_join(F.transform(runs, lambda r: r["text"]), "")
    head = F.regexp_extract(whole, portable(r"^(\s*(?:[0-9]{1,4}|[A-H])\s*[.．、)）]\s*)"), 1)
    length = F.when((F.length(head) <= 12) & ~F.contains(head, F.lit("_")), F.length(head)).otherwise(0)
    start = lambda k: F.aggregate(F.slice(runs, 1, k), F.lit(0), lambda a, r: a + F.length(r["text"]))
    cut = F.transform(runs, lambda r, k: r.withField("text", F.substring(r["text"], F.greatest(length - start(k), F.lit(0)) + 1, F.length(r["text"]))))
    return F.filter(cut, lambda r: r["text"] != "")


def whole_line(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The value of the first rule that matches the line as a whole, groups filled in; other lines stay."""
    out = None
    for pattern, value in rules:
        hit = text.rlike(f"^(?:{portable(pattern)})$")
        out = (F.when if out is None else out.when)(hit, F.regexp_replace(text, f"^(?:{portable(pattern)})$", value))
    return text if out is None else out.otherwise(text)


def content_id(text: Column, n: int = 16) -> Column:
    """The first ``n`` hexadecimal digits of the SHA-256 of ``text``."""
    return F.substring(F.sha2(text, 256), 1, n)


def locator_paragraph(locator: Column) -> Column:
    """The paragraph of a locator: without part prefix, option and drawing suffixes."""
    return F.regexp_replace(F.regexp_replace(locator, r"^[a-z]+[0-9]*:", ""), r"(#[^/]*|/(drawing|shape)\[[0-9]+\].*)$", "")


def locator_table(locator: Column) -> Column:
    """The table of a locator, the locator itself outside tables."""
    return F.substring_index(locator, "/tr[", 1)


def doc_label(number: Column, before: str = "第A", after: str = "讲") -> Column:
    """The label of a document by number, two digits at least."""
    shown = number.cast("string")
    return F.concat(F.lit(before), F.when(F.length(shown) < 2, F.lpad(shown, 2, "0")).otherwise(shown), F.lit(after))


def hierarchy_path(*levels: Column) -> Column:
    """The levels that are neither null nor empty, joined."""
    return F.concat_ws(" / ", *(F.when(x != "", x) for x in levels))


# EMU for one CSS unit.
EMU = {"pt": 12700, "in": 914400, "cm": 360000, "mm": 36000, "pc": 152400, "px": 9525}


def css_emu(length: Column) -> Column:
    """A CSS length in EMU; null without a known unit."""
    number = F.regexp_extract(length, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([a-z]+)\s*$", 1)
    unit = F.regexp_extract(length, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([a-z]+)\s*$", 2)
    factor = None
    for name, emu in EMU.items():
        factor = (F.when if factor is None else factor.when)(unit == name, F.lit(emu))
    return F.when((number != "") & factor.isNotNull(), F.round(F.when(number != "", number.cast("double")) * factor).cast("long"))


def figure_scale(emu: Column, half_points: Column) -> Column:
    """A figure's height relative to the body font; null without a font size."""
    return F.when((half_points > 0) & (emu > 0), F.round((emu / 12700) / (half_points / 2), 4))


def run_type(marks: dict[str, Column], text: Column) -> Column:
    """The type of a run from its marks; the first that holds."""
    painted = marks["shading"].isNotNull() & ~F.upper(marks["shading"]).isin("AUTO", "FFFFFF")
    blank = marks["underline"] & (F.trim(text) == "") & (F.length(text) > 0)
    return (
        F.when(marks["vert"] == "subscript", "subscript")
        .when(marks["vert"] == "superscript", "superscript")
        .when(marks["color"] == "source", "source")
        .when(marks["highlight"] | F.coalesce(painted, F.lit(False)), "highlight")
        .when(blank, "blank")
        .when(marks["underline"], "underline")
        .when(marks["dot"], "emphasis")
        .when(marks["bold"] & (marks["color"] == "topic"), "topic")
        .when(marks["bold"], "bold")
        .when(marks["italic"], "italic")
        .otherwise("plain")
    )


def answer_segments(text: Column) -> Column:
    """The non-blank segments of an answer, without its final stop."""
    return F.filter(F.split(F.regexp_replace(text, r"[.。．]\s*$", ""), "[、，,；;]"), lambda x: F.trim(x) != "")


def terms(side: Column) -> Column:
    """The terms of one side of a reaction, split at plus signs."""
    return F.filter(F.transform(F.split(side, r"\+"), lambda x: F.trim(x)), lambda x: x != "")


def suspicious_term(term: Column) -> Column:
    """A term that is rather prose: over seven characters or with a space inside."""
    return (F.length(term) > 7) | term.rlike(portable(r"\S\s+\S"))


def replace_first(text: Column, pattern: str, value: str) -> Column:
    """Only the first match of ``pattern`` replaced (the built-in replaces all)."""
    at = F.regexp_instr(text, F.lit(pattern))
    found = F.regexp_extract(text, f"({pattern})", 1)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(value), F.substring(text, at + F.length(found), F.length(text)))).otherwise(text)


def title_normalise(text: Column, overrides: dict[str, str], patterns: list[tuple[str, str]]) -> Column:
    """An exact override, else the first pattern that fires, once."""
    out = None
    for old, new in overrides.items():
        out = (F.when if out is None else out.when)(text == old, F.lit(new))
    for pattern, value in patterns:
        hit, new = text.rlike(pattern), replace_first(text, pattern, value)
        out = (F.when if out is None else out.when)(hit, new)
    return out.otherwise(text)


def char_width(char: Column) -> Column:
    """1 for half-width characters, 2 for others."""
    return F.when(F.ascii(char) < 0x2E80, 1).otherwise(2)
