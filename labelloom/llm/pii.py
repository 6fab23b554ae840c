"""Personal data: expressions propose spans, checksums confirm them, words before them add to a score.

Everything is a column expression over one scan. A match's place follows from the lengths of the
matches and of the text between them (``regexp_extract_all`` and ``split`` by the same expression).

Base kinds are kept as their checks say. The others start from a score of their own, a checksum or a
nearby context word adds to it, and ``KEEP_FROM`` decides:

=========  ====================================  ==========================  =====  ===============
kind       expression                            check                       start  context adds
=========  ====================================  ==========================  =====  ===============
iban       country, two digits, 11 to 30 signs   mod-97 is 1 (adds 0.6)      0.3    0.1
card_short 13 to 15 digits                       Luhn (adds 0.3)             0.2    0.4
ssn        3-2-4 digits, no impossible group     -                           0.3    0.5
tel        3-3-4 digits without a plus           -                           0.3    0.5
=========  ====================================  ==========================  =====  ===============

Possessive quantifiers keep the expressions linear, and free of recursion, on texts of any length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import documents

KEEP_FROM = 0.6
#: Characters before a match in which context words count.
CONTEXT = 48

_SPANS = "array<struct<start: bigint, end: bigint>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""
    n = F.length(digits)

    def added(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substring(digits, n - place + 1, F.lit(1))) - 48
        double = 2 * digit
        doubled = F.when(double > 9, double - 9).otherwise(double)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), n), F.lit(0), added) % 10 == 0)


def mod_97(text: Column) -> Column:
    """The remainder by 97 of an account number: first four signs last, A as 10 to Z as 35."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def taken(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(turned, place, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), taken)


@dataclass(frozen=True)
class Kind:
    """What is looked for: ``needs`` occurs in any text with a match; ``check`` and ``score`` get the
    match and the lower-case text before it."""

    name: str
    pattern: str
    needs: str
    keep: object


def _count_between(match: Column, low: int, high: int) -> Column:
    return F.length(_digits(match)).between(low, high)


def _email(match: Column, _: Column) -> Column:
    return F.lit(True)


def _ip(match: Column, _: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return F.regexp_like(match, F.lit(rf"^{part}(?:\.{part}){{3}}$"))


def _card(match: Column, _: Column) -> Column:
    # Guarded, as the checksum of a very long number takes very long.
    return F.when(_count_between(match, 16, 19), luhn(_digits(match))).otherwise(False)


def _phone(match: Column, _: Column) -> Column:
    return _count_between(match, 8, 15)


def _scored(start: float, check: float, word: float, words: str, confirmed=None):
    """Keeps a match whose score, with what the check and a context word add, is high enough."""

    def keep(match: Column, before: Column) -> Column:
        score = F.lit(start) + F.when(F.regexp_like(before, F.lit(words)), word).otherwise(0.0)
        if confirmed is not None:
            score = score + F.when(confirmed(match), check).otherwise(0.0)
        return score >= KEEP_FROM

    return keep


BASE = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        _email,
    ),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _ip),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", _card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", _phone),
]

ADDED = [
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        "",
        _scored(0.3, 0.6, 0.1, r"\b(iban|account|konto|compte|cuenta|bank)\b", lambda m: mod_97(m) == 1),
    ),
    Kind(
        "card_short",
        r"(?<![0-9.+-])[0-9](?:[\x20-]?[0-9]){12,14}(?![\x20-]?[0-9])",
        "",
        _scored(
            0.2, 0.3, 0.4, r"\b(card|credit|amex|visa|karte|carte|tarjeta)\b", lambda m: luhn(_digits(m))
        ),
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        "-",
        _scored(0.3, 0.0, 0.5, r"\b(ssn|social security|sozialversicherung)\b"),
    ),
    Kind(
        "tel",
        r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        "",
        _scored(0.3, 0.0, 0.5, r"\b(tel|telephone|telefon|téléphone|teléfono|phone|call|fax|mobile)\b"),
    ),
]

#: Matches whose places are found in one go; those of a longer list are found block by block.
BLOCK_MATCHES = 256


def spans_of(text: Column, kind: Kind) -> Column:
    """The places of the kept matches: code points, end exclusive."""
    pattern = F.lit(kind.pattern)
    found = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.split(text, kind.pattern, -1).alias("gap"),  # one more than there are matches
    )
    before = lambda x: F.lower(F.right(x["gap"], F.lit(CONTEXT)))
    nothing = F.array().cast(_SPANS)

    def added(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["match"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(_SPANS)
        kept = F.when(kind.keep(x["match"], before(x)), F.concat(so_far["spans"], one))
        return F.struct(end.alias("at"), kept.otherwise(so_far["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("spans"))

    def few(matches: Column) -> Column:
        return F.aggregate(matches, start, added, lambda x: x["spans"])

    def many(matches: Column) -> Column:
        """The same block by block: each step copies the spans so far, so it should have few."""
        no_blocks = F.array().cast(f"array<{_SPANS}>")

        def block(so_far: Column, k: Column) -> Column:
            own = F.slice(matches, k * BLOCK_MATCHES + 1, F.lit(BLOCK_MATCHES))
            inner = F.struct(so_far["at"].alias("at"), nothing.alias("spans"))
            return F.aggregate(
                F.array(F.aggregate(own, inner, added)),  # computed once, used twice
                F.struct(so_far["at"].alias("at"), so_far["blocks"].alias("blocks")),
                lambda s, x: F.struct(
                    x["at"].alias("at"), F.concat(s["blocks"], F.array(x["spans"])).alias("blocks")
                ),
            )

        blocks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK_MATCHES).cast("int"))
        first = F.struct(F.lit(0).cast("long").alias("at"), no_blocks.alias("blocks"))
        return F.flatten(F.aggregate(blocks, first, block, lambda x: x["blocks"]))

    matched = F.filter(found, lambda x: x["match"].isNotNull())
    # As the element of a list it is computed once, however often it is used.
    places = F.transform(
        F.array(matched), lambda m: F.when(F.size(m) <= BLOCK_MATCHES, few(m)).otherwise(many(m))
    )[0]
    if kind.needs:
        return F.when(F.contains(text, F.lit(kind.needs)), places).otherwise(nothing)
    return places


def _told(kind: str, spans: Column) -> Column:
    return F.transform(
        spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` for every row.

    ``spans`` lists ``kind:start:end`` by kind, base kinds first, then by place. A null or empty text
    has none. Each row stands for itself, so repeated rows and a null ``doc_id`` change nothing.
    """
    found = documents(docs).select(
        "doc_id", *(spans_of(F.col("text"), k).alias(k.name) for k in [*BASE, *ADDED])
    )
    told = lambda kinds: F.array_join(F.concat(*(_told(k.name, F.col(k.name)) for k in kinds)), ",")
    size = lambda k: F.size(k.name).cast("long")
    return found.select(
        "doc_id",
        *(size(k).alias(f"n_{k.name}") for k in BASE),
        F.sha2(told(BASE), 256).alias("base_sha256"),
        told([*BASE, *ADDED]).alias("spans"),
        sum((size(k) for k in ADDED[1:]), size(ADDED[0])).alias("n_added"),
    )
