"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything is built from SQL functions. A pattern is applied twice to the texts that can match at all:
once for the matches and once for the text between them; running lengths of both give the positions in
code points. Patterns use possessive repeats and start only where a run of their characters starts (or
where the last match ended), so they find the same leftmost matches as their plain forms in one pass
over the text, without backtracking and without recursion on long runs.

Four base kinds (e-mail, ip, card, phone) are reported whenever their check passes. The other kinds
need a score of at least ``MIN_SCORE``: a prior, raised by a passed checksum and by a word nearby.

Results in odd cases: a null or empty text has no spans; repeated rows are treated alike; very long texts
are searched whole; an empty table gives an empty result. Extra input columns are carried by ``redact``
only, which adds none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import free_name, let

MIN_SCORE = 0.5
NEARBY = 40  # characters on each side of a match, up to the next match of the same kind
CONTEXT = 0.3


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    may_match: Callable[[Column], Column]  # cheap test of the whole text
    check: Callable[[Column], Column]  # of a match
    words: str  # nearby words that raise the score, as a pattern over lower case
    prior: float
    needs_score: bool


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Luhn's checksum of a string of digits."""
    value = lambda i: F.substring(x, F.length(x) - i, F.lit(1)).cast("int")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    add = lambda total, i: total + F.when(i % 2 == 1, doubled(value(i))).otherwise(value(i))
    return F.aggregate(F.sequence(F.lit(0), F.length(x) - 1), F.lit(0), add) % 10 == 0


def mod97(x: Column) -> Column:
    """The checksum of account numbers: four leading signs go to the end, letters count as 10 to 35."""
    plain = F.regexp_replace(x, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    step = lambda r, c: F.when(c >= "A", r * 100 + F.ascii(c) - 55).otherwise(r * 10 + F.ascii(c) - 48) % 97
    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def in_octet(x: Column) -> Column:
    short = F.regexp_replace(x, "^0+(?=[0-9])", "")
    return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)


def card_check(x: Column) -> Column:
    return let(digits(x), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))


def always(x: Column) -> Column:
    return F.lit(True)


# The base patterns are those of the contract, made possessive and anchored at the start of a run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
NATIONAL_ID = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+.()-])(?<![0-9+.)-]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
SECRET = r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,128}(?![A-Za-z0-9])"

KINDS = (
    Kind("email", EMAIL, lambda t: F.contains(t, F.lit("@")), always, "mail|contact|write", 0.8, False),
    Kind("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda x: F.forall(F.split(x, r"\."), in_octet), r"\bip\b|host|server|address", 0.6, False),
    Kind("card", CARD, lambda t: t.rlike(r"[0-9](?:[\x20-]?+[0-9]){11}"), card_check, "card|visa|credit|pay|karte|carte|tarjeta", 0.6, False),
    Kind("phone", PHONE, lambda t: F.contains(t, F.lit("+")), lambda x: F.length(digits(x)).between(9, 15), "phone|tel|call|mobil|fax", 0.6, False),
    Kind("iban", IBAN, lambda t: t.rlike("[A-Z]{2}[0-9]{2}"), mod97, "iban|account|konto|compte|cuenta|bank", 0.6, True),
    Kind("national_id", NATIONAL_ID, lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"), always, "ssn|social security|national id", 0.3, True),
    Kind("local_phone", LOCAL_PHONE, lambda t: t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), always, "phone|tel|call|mobil|fax", 0.3, True),
    Kind("secret", SECRET, lambda t: t.rlike("[0-9A-Fa-f]{32}"), always, "token|secret|passw|api.?key|credential", 0.3, True),
)
BASE = ("email", "ip", "card", "phone")


def running_sum(values: Column) -> Column:
    """Sums of the first 1, 2, ... values, in chunks of about the root of their number."""
    grow = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"] + x)).alias("all"))
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    sums = lambda xs: F.aggregate(xs, start, grow, lambda a: a["all"])

    def chunked(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        chunks = F.transform(F.sequence(F.lit(1), F.size(v), size), lambda s: sums(F.slice(v, s, size)))
        add = lambda bases: lambda c, i: F.transform(c, lambda x: x + F.coalesce(F.get(bases, i - 1), F.lit(0)))
        return let(chunks, lambda cs: let(sums(F.transform(cs, lambda c: F.element_at(c, -1))), lambda bases: F.flatten(F.transform(cs, add(bases)))))

    return F.when(F.size(values) > 0, chunked(values)).otherwise(F.array().cast("array<int>"))


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def spans_of(text: Column, rank: int, kind: Kind) -> Column:
    """Confirmed spans of one kind."""

    def located(found: Column) -> Column:
        parts = let(F.transform(found["m"], lambda x, i: F.length(F.get(found["p"], i)) + F.length(x)), running_sum)

        def span(ends: Column) -> Callable[[Column, Column], Column]:
            def build(x: Column, i: Column) -> Column:
                before, after = F.get(found["p"], i), F.get(found["p"], i + 1)
                near = F.lower(F.concat(F.right(before, F.lit(NEARBY)), F.lit(" "), F.left(after, F.lit(NEARBY))))
                score = F.when(kind.check(x), kind.prior + F.when(near.rlike(kind.words), CONTEXT).otherwise(0.0)).otherwise(-1.0)
                end = F.get(ends, i)
                return F.struct((end - F.length(x)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"), score.alias("score"))

            return build

        passing = lambda s: s["score"] >= (MIN_SCORE if kind.needs_score else 0.0)
        return let(parts, lambda ends: F.filter(F.transform(found["m"], span(ends)), passing))

    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    all_spans = let(F.struct(matches.alias("m"), F.split(text, kind.pattern, -1).alias("p")), located)
    return F.when(kind.may_match(text), all_spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def spans(text: Column) -> Column:
    """All spans of a text by start and rank of kind."""
    return F.array_sort(F.concat(*(spans_of(text, i, k) for i, k in enumerate(KINDS))))


def is_kind(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def as_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (array of start, rank, end, kind, score)."""
    found = let(F.coalesce(F.col(text_col), F.lit("")), lambda t: spans(t))
    return docs.select(F.col(id_col).alias("doc_id"), F.inline(F.array(F.struct(found.alias("spans")))))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""

    def step(a: Column, s: Column) -> Column:
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        between = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        grown = F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(between, label))).otherwise(a["parts"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), grown.alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    close = lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1))
    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(found, start, step, close))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced in the text; null texts stay null. A column of lengths follows."""
    name = free_name(docs, "found_spans")
    found = let(F.coalesce(F.col(text_col), F.lit("")), lambda t: spans(t))
    marked = docs.select("*", F.inline(F.array(F.struct(found.alias(name)))))
    text = redacted(F.col(text_col), F.col(name))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        marked = marked.withColumn(length_col, F.when(F.size(name) == 0, F.col(length_col)).otherwise(F.length(text).cast(kind)))
    return marked.withColumn(text_col, text).select(*docs.columns)
