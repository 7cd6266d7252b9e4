"""Rules are written as Python regular expressions; here they become patterns that Java and RE2 read alike.

Only constructs whose meaning differs between the engines are rewritten: white space, digits, word
characters and the dot. ``match`` anchors at the start, ``search`` does not.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's \s matches in text.
SPACES = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_CLASSES = {"s": SPACES, "d": r"\p{Nd}", "w": r"\p{L}\p{N}_"}


def portable(pattern: str) -> str:
    """``pattern`` with classes spelled out, for Java and RE2."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            n = pattern[at + 1]
            at += 2
            if n.lower() in _CLASSES and not (n.isupper() and inside):
                spelled = _CLASSES[n.lower()]
                out.append(spelled if inside else f"[{'^' if n.isupper() else ''}{spelled}]")
            elif n == "u":
                out.append(f"\\x{{{pattern[at : at + 4]}}}")
                at += 4
            elif n == "Z":
                out.append("$")
            else:
                out.append("\\" + n)
            continue
        if c == "[" and not inside:
            inside = True
        elif c == "]" and inside and pattern[at - 1] != "[" and pattern[at - 2 : at] != "[^":
            inside = False
        out.append(r"[^\n]" if c == "." and not inside else c)
        at += 1
    return "".join(out)


def matching(pattern: str) -> str:
    """Anchored at the start, as ``re.match``."""
    return f"^(?:{portable(pattern)})"


def filled(pattern: str, values: dict[str, str]) -> str:
    """``pattern`` with each placeholder ``{name}`` as a class of the characters given for it; others, and counts like {2}, stay."""
    return re.sub(r"\{([A-Za-z]\w*)\}", lambda m: f"[{re.escape(values[m[1]])}]" if m[1] in values else m[0], pattern)


@dataclass(frozen=True)
class Rule:
    order: int
    id: str
    kind: str
    pattern: str


class BadRules(ValueError):
    """A rule table that cannot be used."""


def ordered(rules: list[Rule]) -> list[Rule]:
    if not rules:
        raise BadRules("no rules: an empty table would classify nothing")
    return sorted(rules, key=lambda r: r.order)


def _needed(parsed) -> list[str]:
    """Of a parsed pattern: texts of which one stands in every match; none where that can't be told."""
    found: list[list[str]] = []
    run = ""
    for op, value in [*parsed, (None, None)]:
        if op is _parser.LITERAL:
            run += chr(value)
            continue
        if run:
            found.append([run])
        run = ""
        if op is _parser.SUBPATTERN and not value[1] & re.IGNORECASE:
            found.append(_needed(value[3]))
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and value[0]:
            found.append(_needed(value[2]))
        elif op is _parser.BRANCH:
            each = [_needed(x) for x in value[1]]
            found.append(sum(each, []) if all(each) else [])
    return max(filter(None, found), key=lambda texts: (min(map(len, texts)), -len(texts)), default=[])


def needed(pattern: str) -> list[str]:
    """Texts of which one stands in whatever ``pattern`` matches; none where that can't be told."""
    parsed = _parser.parse(pattern)
    return [] if parsed.state.flags & re.IGNORECASE else _needed(parsed)


def matches(pattern: str, text: Column) -> Column:
    """Whether ``pattern`` matches at the start of ``text``. Texts that lack what it needs are told without the pattern, which may go over them again and again."""
    hit, texts = text.rlike(matching(pattern)), needed(pattern)
    return reduce(or_, (F.contains(text, F.lit(x)) for x in texts)) & hit if texts else hit


def first_match(rules: list[Rule], text: Column, otherwise: str, field: str = "id") -> Column:
    """The ``field`` of the first rule, by order, whose pattern matches at the start of ``text``."""
    out = None
    for rule in ordered(rules):
        hit, value = matches(rule.pattern, text), F.lit(getattr(rule, field))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.lit(otherwise))


def kind_of(rules: list[Rule], role: Column, otherwise: str = "body") -> Column:
    """The kind of a role id: that of its first rule. One look-up, so that ``role`` is evaluated once."""
    kinds: dict[str, str] = {}
    for rule in ordered(rules):
        kinds.setdefault(rule.id, rule.kind)
    known = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    return F.coalesce(F.try_element_at(known, role), F.lit(otherwise))


def sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def first_match_sql(rules: list[Rule], text: str, otherwise: str, field: str = "id") -> str:
    """The same as :func:`first_match`, in SQL with RE2 patterns."""
    cases = " ".join(f"WHEN regexp_matches({text}, {sql_literal(matching(r.pattern))}) THEN {sql_literal(getattr(r, field))}" for r in ordered(rules))
    return f"CASE {cases} ELSE {sql_literal(otherwise)} END"


def kind_of_sql(rules: list[Rule], role: str, otherwise: str = "body") -> str:
    first: dict[str, str] = {}
    for rule in ordered(rules):
        first.setdefault(rule.id, rule.kind)
    return "CASE " + " ".join(f"WHEN {role} = {sql_literal(i)} THEN {sql_literal(k)}" for i, k in first.items()) + f" ELSE {sql_literal(otherwise)} END"
