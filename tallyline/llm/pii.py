"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Everything is built-in functions.  A text is cut at a pattern's matches: the pieces between them give the positions
(sums of lengths in code points) and the words nearby, so no position is searched twice.  Possessive repeats and
anchored starts keep every pattern linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import packed, text_of, unpacked

#: Code points on each side in which context words count.
NEARBY = 40
#: An added span needs this score; base spans stay whatever their score is.
LEAST_SCORE = 0.6
#: What one context word nearby adds to a score.
CONTEXT_GAIN = 0.3

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = "[A-Za-z0-9._%+-]"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    doubled = F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def weight(place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place, F.lit(1)).cast("int")
        return F.when(place % 2 == 1, F.get(doubled, digit)).otherwise(digit)

    return F.aggregate(F.transform(places, weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code (country, check digits, rest; no blanks) leaves 1 modulo 97."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def value(place: Column) -> Column:
        return F.ascii(F.substring(turned, place, F.lit(1)))

    def step(rest: Column, sign: Column) -> Column:
        return F.when(sign <= 57, (rest * 10 + sign - 48) % 97).otherwise((rest * 100 + sign - 55) % 97)

    signs = F.transform(F.sequence(F.lit(1), F.length(turned)), value)
    return F.aggregate(signs, F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, its check, its score and the words that raise it."""

    name: str
    pattern: str
    base: bool
    score: float
    context: str

    def confirms(self, match: Column) -> Column:
        if self.name == "ip":
            return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
        if self.name == "card":
            digits = _digits(match)
            return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
        if self.name == "phone":
            return F.length(_digits(match)).between(9, 15)
        if self.name == "iban":
            return mod97(F.regexp_replace(match, " ", ""))
        return F.lit(True)


#: In the order in which spans of one start are listed.  The first four are the base.
KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, 0.9, "mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, 0.7, "ip|address|host|server"),
    Kind("card", r"[0-9]++(?:[\x20-][0-9]++)*+", True, 0.9, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True, 0.7, "tel|phone|call|fax|mobile|anruf|appel"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", False, 0.9, "iban|account|bank|konto|compte|cuenta"),
    Kind("local_phone", r"(?<![0-9(+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", False, 0.4, "tel|phone|call|fax|mobile|anruf|appel"),
    Kind("id_number", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, 0.4, "ssn|social|security|passport|identity"),
    Kind("secret", r"(?<![A-Za-z0-9])[0-9a-f]{24,64}(?![A-Za-z0-9])", False, 0.4, "token|key|secret|password|passwd"),
)
_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>"


def _spans(number: int, kind: Kind, gaps: Column, matches: Column) -> Column:
    """The confirmed spans of one kind from the pieces around its matches."""
    nothing = F.array().cast("array<struct<start:int,end:int,match:string,nearby:string>>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    places = F.sequence(F.lit(0), F.size(matches) - 1)

    def place(state: Column, i: Column) -> Column:
        before, match, after = F.get(gaps, i), F.get(matches, i), F.get(gaps, i + 1)
        begins = state["at"] + F.length(before)
        ends = begins + F.length(match)
        nearby = F.lower(F.concat_ws(" ", F.right(before, F.lit(NEARBY)), F.left(after, F.lit(NEARBY))))
        one = F.struct(begins.alias("start"), ends.alias("end"), match.alias("match"), nearby.alias("nearby"))
        out = F.when(kind.confirms(match), F.concat(state["out"], F.array(one))).otherwise(state["out"])
        return F.struct(ends.alias("at"), out.alias("out"))

    def scored(x: Column) -> Column:
        gain = F.when(x["nearby"].rlike(rf"(?<![a-z])(?:{kind.context})"), F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
        return F.struct(
            x["start"].alias("start"), F.lit(number).alias("kind_no"), x["end"].alias("end"), F.lit(kind.name).alias("kind"),
            F.least(F.lit(1.0), F.round(F.lit(kind.score) + gain, 3)).alias("score"),
        )

    found = F.transform(F.aggregate(places, start, place, lambda s: s["out"]), scored)
    return F.when(F.size(matches) > 0, found).otherwise(F.array()).cast(_SPAN)


def personal_data(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """The frame with column ``into``: an array of spans (start, kind_no, end, kind, score), sorted.

    Positions are code points, ends exclusive; matches of a kind are the leftmost that do not overlap, and a match that
    its check refuses is dropped without another try.  Base kinds: email, ip (parts to 255), card (12 to 19 digits
    with a right Luhn sum), phone (9 to 15 digits).  The other kinds are added if their score, raised by context words
    nearby, is at least ``LEAST_SCORE`` and no base span overlaps them: iban (right modulo 97), local_phone,
    id_number, secret.  Spans are sorted by start, then kind as listed.  Null and empty texts have no spans.
    """
    frame = packed(docs, text=text_of(docs, text))
    for n, kind in enumerate(KINDS):
        frame = frame.withColumn(f"m{n}", F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0)))
        # texts without a match are not cut: the only piece would be the text itself
        pieces = F.when(F.size(f"m{n}") > 0, F.split("text", kind.pattern, -1))
        frame = frame.withColumn(f"g{n}", pieces)
    found = [_spans(n, kind, F.col(f"g{n}"), F.col(f"m{n}")).alias(f"s{n}") for n, kind in enumerate(KINDS)]
    frame = frame.select("row", *found)
    base = F.concat(*[F.col(f"s{n}") for n, k in enumerate(KINDS) if k.base])
    added = F.concat(*[F.col(f"s{n}") for n, k in enumerate(KINDS) if not k.base])
    frame = frame.select("row", base.alias("base"), added.alias("added"))

    def stays(x: Column) -> Column:
        overlaps = F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))
        return (x["score"] >= LEAST_SCORE) & ~overlaps

    spans = F.array_sort(F.concat("base", F.filter("added", stays)))
    return unpacked(frame, docs.columns, **{into: spans})


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
