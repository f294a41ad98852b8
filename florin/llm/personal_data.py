"""Personal data: regular expressions propose spans, checksums confirm them, context words score them.

Base kinds, leftmost and non-overlapping per kind: email, ip (every part at most 255),
card (12 to 19 digits passing Luhn), phone (9 to 15 digits). Added by the method: iban
(mod 97) and tel (a number in national notation, taken when a context word before it raises
its score to the threshold).

A context word counts within 32 characters before a span, as far as the span of the same
pattern before it. Where no letter stands between the two, and no more than 32 characters,
the later one goes on with a list and has the context of the one before. Words behind a
span do not count.

The expressions are the plain ones in a form that a backtracking engine runs in linear
time: a run of characters is entered at its first character or where the last match
ended, and never given back. Positions are code points and come from the lengths of the
matches and of the pieces between them. Everything is built-in expressions.

Defined results: NULL is an empty text without spans; a text without spans has empty
span lists; repeated rows and ties keep their rows; texts of any length are searched
whole; masking changes no text without spans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.llm.columns import free_name

_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    base: float  # score of a confirmed span without context
    context: str  # words that raise the score, as alternatives
    mask: str


# In the order of the kinds within equal starts.
KINDS = [
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write", "[EMAIL]"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address|addr", "[IP]"),
    # A card is a longest run of digits with single separators, so it has no digit before or behind.
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", 0.8, "card|visa|master|credit|pay", "[CARD]"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", 0.7, "call|phone|tel|mobile|fax", "[PHONE]"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", 0.9, "iban|bank|account|konto|cuenta", "[IBAN]"),
    Kind("tel", r"(?<![0-9+.(-])\(?[0-9]{3,4}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", 0.3, "call|phone|tel|mobile|fax", "[PHONE]"),
]
BASE_KINDS = ("email", "ip", "card", "phone")
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 32  # before a span
THRESHOLD = 0.5  # for the kinds the method adds
CHUNK = 256


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def mod_97(iban: Column) -> Column:
    """Remainder of the rearranged number; 1 for a valid IBAN. At most 34 characters."""
    bare = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    values = F.transform(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55),
    )
    return F.aggregate(values, F.lit(0), lambda rest, v: (rest * F.when(v > 9, 100).otherwise(10) + v) % 97)


def confirmed(kind: str, found: Column) -> Column:
    """Whether a proposed span of the kind passes its checks."""
    if kind == "ip":
        return found.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        return luhn(digits_of(found))
    if kind == "phone":
        return F.length(digits_of(found)).between(9, 15)
    if kind == "iban":
        return (F.length(F.replace(found, F.lit(" "), F.lit(""))) >= 15) & (mod_97(found) == 1)
    return F.lit(True)


def _before(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """All values before every element, added up, in two levels so that long arrays stay cheap."""

    def running(values: Column, first: Column) -> Column:
        empty = F.struct(F.array().cast("array<bigint>").alias("before"), first.alias("sum"))
        return F.aggregate(
            values,
            empty,
            lambda state, v: F.struct(F.concat(state["before"], F.array(state["sum"])).alias("before"), add(state["sum"], v).alias("sum")),
            lambda state: state["before"],
        )

    n_chunks = F.ceil(F.size(values) / CHUNK).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), n_chunks - 1), lambda i: F.slice(values, i * CHUNK + 1, F.lit(CHUNK))
    )
    sums = F.transform(chunks, lambda c: F.aggregate(c, zero, add))
    pairs = F.arrays_zip(chunks.alias("chunk"), running(sums, zero).alias("first"))
    return F.flatten(F.transform(pairs, lambda p: running(p["chunk"], p["first"])))


def _starts(lengths: Column) -> Column:
    return _before(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _contexts(pieces: Column, kind: Kind) -> Column:
    """Whether a context word stands before every match, from the pieces before the matches."""

    def own(piece: Column, i: Column) -> Column:
        near = F.lower(F.substring(piece, F.greatest(F.length(piece) - CONTEXT_CHARS + 1, F.lit(1)), F.lit(CONTEXT_CHARS)))
        listed_on = (F.length(piece) <= CONTEXT_CHARS) & ~piece.rlike(r"\p{L}")
        known = 2 * i.cast("bigint") + F.when(near.rlike(rf"\b(?:{kind.context})"), 1).otherwise(0)
        return F.when(listed_on, F.lit(-1).cast("bigint")).otherwise(known)

    # The last piece that has a say is the largest number; odd ones have a word.
    values = F.transform(pieces, own)
    before = _before(values, F.lit(-1).cast("bigint"), lambda a, b: F.greatest(a, b))
    return F.zip_with(before, values, lambda a, b: F.greatest(a, b) % 2 == 1)


def spans_of(text: Column, kind: Kind) -> Column:
    """Confirmed spans of a kind: array of (start, rank, end, kind, score), in text order."""
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    # One piece before every match; the piece behind the last is not needed.
    pieces = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
    sizes = F.zip_with(pieces, found, lambda p, m: (F.length(p) + F.length(m)).cast("bigint"))
    rows = F.arrays_zip(found.alias("m"), pieces.alias("p"), _starts(sizes).alias("at"), _contexts(pieces, kind).alias("near"))
    rank = [k.name for k in KINDS].index(kind.name)

    def span(row: Column) -> Column:
        score = F.lit(kind.base) + F.when(row["near"], CONTEXT_BONUS).otherwise(0.0)
        start = row["at"] + F.length(row["p"])
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + F.length(row["m"])).alias("end"),
            F.lit(kind.name).alias("kind"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    spans = F.transform(F.filter(rows, lambda r: confirmed(kind.name, r["m"])), span)
    if kind.name not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    # Most texts have no match: they skip the rest.
    return F.when(F.size(found) > 0, spans).otherwise(none)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (start, rank, end, kind, score), by start, then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    columns = {free_name(docs, f"_{kind.name}"): spans_of(whole, kind) for kind in KINDS}
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    every = F.array_sort(F.concat(*[F.col(name) for name in columns]))
    return docs.select(*kept, *[c.alias(name) for name, c in columns.items()]).select(*kept, every.alias("spans"))


# The kind that can contain others comes first: a card or an address inside a phone goes
# with it, and digits before an e-mail's are seen whole.
MASK_ORDER = ("iban", "phone", "card", "email", "ip", "tel")


def _masked_kind(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    pieces = F.split(text, kind.pattern, -1)

    before = F.slice(pieces, F.lit(1), F.size(found))
    rows = F.arrays_zip(before.alias("p"), found.alias("m"))
    scored = kind.name not in BASE_KINDS and kind.base < THRESHOLD
    if scored:
        rows = F.arrays_zip(before.alias("p"), found.alias("m"), _contexts(before, kind).alias("near"))

    def replaced(row: Column) -> Column:
        sure = confirmed(kind.name, row["m"])
        if scored:
            sure = sure & row["near"]
        return F.concat(row["p"], F.when(sure, F.lit(kind.mask)).otherwise(row["m"]))

    last = F.element_at(pieces, -1)
    joined = F.concat(
        F.array_join(F.transform(rows, replaced), ""), last
    )
    return F.when(F.size(found) > 0, joined).otherwise(text)


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every confirmed span replaced by its kind; ``n_chars`` follows the text where it is a column."""
    step = docs
    by_name = {kind.name: kind for kind in KINDS}
    for name in MASK_ORDER:
        # A step of its own each: the text is used several times in one expression.
        step = step.withColumn("text", _masked_kind(F.col("text"), by_name[name]))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        step = step.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return step.select(*[F.col(f"`{c}`") for c in docs.columns])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, scored of every row."""
    spans = found_spans(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
