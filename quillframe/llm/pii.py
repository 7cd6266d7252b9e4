"""Personal data: patterns propose spans, checksums confirm them, words near them adjust a score.

DataFrame functions only. All matches of a pattern are found in one pass: the pattern's matches are
fenced by a control character, the text is split there, and running totals of the pieces' lengths give
positions in code points (that character itself, should a text hold it, first becomes another of one
code point that no pattern matches). Patterns are possessive and start only where an earlier start is
impossible, which gives the leftmost non-overlapping matches in time linear in the text.

Kinds, in order: email, ip, card, phone are confirmed by their digits alone and always stay; iban needs
the mod-97 checksum; ssn needs context words to reach ``LEAST_SCORE``. The context of a span is the CONTEXT
code points before it and after it, whatever other matches they hold.

Defined results: a null or empty text has no spans (``base_sha256`` is that of the empty string). Rows
are judged one by one, so repeated rows get equal results. Columns of the input other than ``text`` are
only carried; own column names win over none of them, because spans come in one struct array whose name
the caller gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FENCE, STAND_IN = "\u0001", "�"
CONTEXT = 40
_REACH = CONTEXT + 1  # so many pieces hold CONTEXT code points at least: every second one is a match, of two or more
_HEAD = 2 * CONTEXT  # what follows the first four code points of an IBAN: 39 at most, and its context; its matches have four
LEAST_SCORE = 0.5
_STEP = 512

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]{4}){2})",  # its first four; IBAN finds the rest
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
IBAN = r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Score of a confirmed span, and what context words (lower case, anywhere in the context) add or take.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
RAISES = {
    "email": "mail|contact|write to|reach",
    "ip": "address|host|server|login|client",
    "card": "card|visa|master|amex|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax|whatsapp",
    "iban": "iban|bank|account|konto|compte|cuenta|bic|swift",
    "ssn": "ssn|social security|tax",
}
LOWERS = {"ip": "version|release|section", "card": "order no|serial|tracking", "phone": "isbn|part no", "ssn": "part no|serial"}
RAISE, LOWER = 0.3, 0.3

SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>"


def _starts(lengths: Column) -> Column:
    """Exclusive running totals of an array of int, by runs of _STEP so that no long array is copied often."""
    last = F.floor((F.size(lengths) - 1) / _STEP).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(lengths, k * _STEP + 1, _STEP))
    extend = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    within = F.transform(runs, lambda r: F.aggregate(r, F.array(F.lit(0)), extend))
    before = F.slice(F.aggregate(within, F.array(F.lit(0)), lambda a, s: extend(a, F.element_at(s, -1))), F.lit(1), last + 1)
    return F.flatten(F.zip_with(within, before, lambda s, b: F.transform(F.slice(s, F.lit(1), F.size(s) - 1), lambda v: v + b)))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Whether the digits of ``x`` pass: every second one from the right doubled, its digits summed."""
    each = F.transform(F.split(F.reverse(_digits(x)), ""), lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def _mod_97(x: Column) -> Column:
    """Whether country and check digits, moved to the end, with letters as 10 to 35, leave 1."""
    flat = F.regexp_replace(x, " ", "")
    turned = F.split(F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(turned, F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97) == 1


def _confirmed(kind: str, x: Column) -> Column:
    n = F.length(_digits(x))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(x, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    if kind == "card":
        return n.between(14, 19) & _luhn(x)
    if kind == "phone":
        return n.between(10, 15)
    if kind == "ssn":
        return ~x.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _iban(x: Column) -> Column:
    """The longest text that ``x`` begins with, up to its end or a space, that is an IBAN; else null.

    Upper-case words after an IBAN look like groups of it, so each end is tried. The longest leaves no part of one.
    """
    words = F.split(F.regexp_extract(x, IBAN, 0), " ")
    ends = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    return F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.filter(ends, lambda e: F.length(F.regexp_replace(e, " ", "")).between(15, 34) & _mod_97(e))), -1)


def _score(kind: str, context: Column) -> Column:
    score = F.lit(SCORES[kind]) + F.when(context.rlike(RAISES[kind]), RAISE).otherwise(0.0)
    if kind in LOWERS:
        score = score - F.when(context.rlike(LOWERS[kind]), LOWER).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2)


def _fenced(text: Column, kind: str) -> Column:
    """Pieces of ``text``: even ones lie between matches, odd ones are matches."""
    return F.split(F.regexp_replace(F.translate(text, FENCE, STAND_IN), PATTERNS[kind], f"{FENCE}$0{FENCE}"), FENCE)


def _found(pieces: Column, starts: Column, heads: Column, tails: Column, kind: str) -> Column:
    """The confirmed spans of one kind, from its pieces, where each begins, and the first and last code points of each."""

    def following(i: Column) -> Column:
        return F.array_join(F.slice(heads, i + 2, F.lit(_REACH)), "")

    def span(i: Column, text: Column, after: Column) -> Column:
        least = F.greatest(i - _REACH, F.lit(0))
        before = F.right(F.array_join(F.slice(tails, least + 1, i - least), ""), F.lit(CONTEXT))
        near = F.lower(F.concat_ws(" ", before, F.left(after, F.lit(CONTEXT))))
        start = F.get(starts, i)
        return F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("kind_no"),
            (start + F.length(text)).alias("end"),
            F.lit(kind).alias("kind"),
            _score(kind, near).alias("score"),
        )

    odd = F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))
    if kind == "iban":
        tried = F.transform(odd, lambda i: F.struct(i.alias("i"), _iban(F.concat(F.get(pieces, i), following(i))).alias("text")))
        right = F.filter(tried, lambda t: t["text"].isNotNull())
        spans = F.transform(right, lambda t: span(t["i"], t["text"], F.substring(following(t["i"]), F.length(t["text"]) - 3, F.lit(CONTEXT))))
    else:
        spans = F.transform(F.filter(odd, lambda i: _confirmed(kind, F.get(pieces, i))), lambda i: span(i, F.get(pieces, i), following(i)))
    if kind not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)
    return F.when(F.size(pieces) > 1, spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def _apart(spans: Column) -> Column:
    """Spans of one kind in order, without those that begin inside the one before."""
    return F.filter(spans, lambda s, k: F.coalesce(s["start"] >= F.get(spans, k - 1)["end"], F.lit(True)))


def with_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with all spans of ``text`` in the array ``into``, by start, then kind as listed.

    A span has start and end (code points, end exclusive), kind, kind_no and score.
    """
    pieces, starts, heads, tails = ({k: f"__{into}_{k}_{what}" for k in KINDS} for what in ("pieces", "starts", "heads", "tails"))
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    staged = docs.select("*", *(_fenced(source, k).alias(pieces[k]) for k in KINDS))
    # A column of its own: inside the lambdas below, an expression would be computed anew for every span.
    each = {k: {starts[k]: _starts(F.transform(pieces[k], F.length)), heads[k]: F.transform(pieces[k], lambda p: F.left(p, F.lit(_HEAD))), tails[k]: F.transform(pieces[k], lambda p: F.right(p, F.lit(CONTEXT)))} for k in KINDS}
    staged = staged.select("*", *(F.when(F.size(pieces[k]) > 1, c).alias(name) for k in KINDS for name, c in each[k].items()))
    spans = {k: f"__{into}_{k}_spans" for k in KINDS}
    staged = staged.select("*", *(_found(*(F.col(f"`{x[k]}`") for x in (pieces, starts, heads, tails)), k).alias(spans[k]) for k in KINDS))
    found = F.concat(*(_apart(F.col(f"`{spans[k]}`")) if k == "iban" else F.col(f"`{spans[k]}`") for k in KINDS))
    return staged.withColumn(into, F.sort_array(found)).drop(*(c for x in (pieces, starts, heads, tails, spans) for c in x.values()))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _unions(spans: Column) -> Column:
    """Sorted spans with those that overlap made one, of the first one's kind."""

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        wide = F.struct(*(F.greatest(last[x], s[x]).alias(x) if x == "end" else last[x].alias(x) for x in ("start", "kind_no", "end", "kind", "score")))
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wide))
        return F.when(F.coalesce(s["start"] < F.get(done, F.size(done) - 1)["end"], F.lit(False)), grown).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast(SPAN), lambda a, s: F.when(F.size(a) == 0, F.array(s)).otherwise(merge(a, s)).cast(SPAN))


def with_masked(docs: DataFrame, text: str, spans: str, into: str) -> DataFrame:
    """``docs`` with ``into``: ``text`` where each span, or union of overlapping ones, is its first kind in brackets."""
    whole = f"__{into}_unions"
    source, unions = F.col(f"`{text}`"), F.col(f"`{whole}`")

    def piece(s: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get(unions, k - 1)["end"]).otherwise(0)
        return F.concat(F.substring(source, before + 1, s["start"] - before), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    rest = F.get(unions, F.size(unions) - 1)["end"]
    out = F.concat(F.array_join(F.transform(unions, piece), ""), F.substring(source, rest + 1, F.length(source) - rest))
    staged = docs.withColumn(whole, F.when(F.size(spans) > 0, _unions(F.col(f"`{spans}`"))))
    return staged.withColumn(into, F.when(unions.isNotNull(), out).otherwise(source)).drop(whole)


def masked_out(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` masked and, where it exists, n_chars brought up to date; null stays null."""
    marked = with_masked(with_spans(docs, into="__spans"), "text", "__spans", "__masked")
    value = {"text": F.col("__masked")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.length("__masked").cast(docs.schema["n_chars"].dataType)
    return marked.select(*(value.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
