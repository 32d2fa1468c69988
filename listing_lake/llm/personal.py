"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby change their score.

Column expressions only.  A text split by a pattern gives what lies between its matches, so matches and
gaps together give each span's place without a pass per match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(_digits(hit)).between(low, high)


def _card(hit: Column) -> Column:
    return _between(12, 19)(hit) & F.call_function("luhn_check", _digits(hit))


def _ip(hit: Column) -> Column:
    part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return hit.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _mod97(hit: Column) -> Column:
    """Whether the account number, its first four characters put last and letters as 10 to 35, leaves 1 modulo 97."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    left = F.aggregate(turned, F.lit(0), lambda r, c: (r * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)
    return left == 1


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` must not go back over what it has read: a possessive quantifier where the next character
    cannot be in the class, and no start inside a run that an earlier start would have covered.
    ``base`` spans stay whatever their score.
    """

    name: str
    needs: str  #: pattern found in every text with a match, quick to look for
    pattern: str
    holds: Callable[[Column], Column] | None = None
    checksum: bool = False  #: ``holds`` is one
    context: str = ""  #: pattern of words that raise the score, in lower case
    base: bool = True


_LOCAL = "[A-Za-z0-9._%+-]"
#: In the order in which spans of one start are listed.  A local part or a number does not begin within
#: its own run of characters unless the last match ended there, which keeps long runs linear.
KINDS = [
    Kind("email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", context="e-?mail|contact|courriel|correo"),
    Kind("ip", "[0-9][.][0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, context=r"\bip\b|address|server|host"),
    Kind("card", "[0-9]", r"[0-9](?:[\x20-]?[0-9])++", _card, True, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", "[+][0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", _between(9, 15), context="phone|call|mobile|fax|telefon|tel"),
    Kind(
        "iban", "[A-Z][0-9]{2}", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", _mod97, True,
        "iban|account|konto|compte|cuenta", base=False,
    ),
    Kind("ssn", "[0-9]-[0-9]", "[0-9]{3}-[0-9]{2}-[0-9]{4}", context="ssn|social security|taxpayer", base=False),
]

#: Score of a match, what a checksum and a word nearby add, the least score of an added span, and how near.
MATCHED, CONFIRMED, NAMED, LEAST, NEAR = 0.4, 0.4, 0.2, 0.6, 40

#: Spans whose starts are added up in one list before it is set aside.
_RUN = 256
_FOUND = "array<struct<start: int, hit: string, near: string>>"


def _located(text: Column, pattern: str) -> Column:
    """All matches, leftmost first and without overlap, as (start, hit, what lies before it since the last)."""
    pairs = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")),
    )

    # finished lists of starts are set aside, so that none is copied more than a bounded number of times
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("run"), F.array().cast(f"array<{_FOUND}>").alias("done"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        span = F.array(F.struct(start.alias("start"), x["hit"].alias("hit"), F.right(x["gap"], F.lit(NEAR)).alias("near")))
        full = F.size(acc["run"]) >= _RUN
        return F.struct(
            (start + F.char_length(x["hit"])).alias("at"),
            F.when(full, span).otherwise(F.concat(acc["run"], span)).alias("run"),
            F.when(full, F.concat(acc["done"], F.array(acc["run"]))).otherwise(acc["done"]).alias("done"),
        )

    real = F.filter(pairs, lambda x: x["hit"].isNotNull())
    return F.aggregate(real, begin, add, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["run"]))))


def _spans(kind: Kind) -> Column:
    """(start, end, score) of the kind's spans in ``text``: confirmed, and of added kinds those with enough score."""
    text = F.col("text")
    found = F.when(text.rlike(kind.needs), _located(text, kind.pattern)).otherwise(F.array().cast(_FOUND))
    if kind.holds is not None:
        found = F.filter(found, lambda x: kind.holds(x["hit"]))
    context = lambda near: F.lower(near).rlike(kind.context) if kind.context else F.lit(False)
    score = lambda x: F.lit(MATCHED + CONFIRMED * kind.checksum) + F.when(context(x["near"]), NAMED).otherwise(0.0)
    scored = F.transform(
        found,
        lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.char_length(x["hit"])).alias("end"), F.round(score(x), 3).alias("score")),
    )
    return scored if kind.base else F.filter(scored, lambda x: x["score"] >= LEAST)


def _marked(kind: Kind, order: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), x["end"].alias("end"),
        x["score"].alias("score"), F.lit(kind.base).alias("base"),
    )


def find(docs: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_<kind>`` of each base kind, and ``spans``.

    ``spans`` is an array of (start, order of the kind, kind, end, score, base), sorted by start and then by
    kind, in code points of the whole text with the end excluded.  A null text is empty; texts without
    personal data get an empty array; repeated rows are judged one by one, other columns are ignored, an
    empty table gives an empty result.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    per_kind = texts.select("doc_id", *[_spans(k).alias(k.name) for k in kinds])
    marked = [F.transform(k.name, _marked(k, i)) for i, k in enumerate(kinds)]
    counts = [F.size(k.name).cast("long").alias(f"n_{k.name}") for k in kinds if k.base]
    return per_kind.select("doc_id", *counts, F.array_sort(F.concat(*marked)).alias("spans"))


def written_out(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
