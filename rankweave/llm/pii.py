"""Personal data (operator 1), in built-in SQL functions alone.

Regular expressions propose spans, checksum validators confirm them and nearby
context words move the score of the kinds that a checksum can't settle. The
patterns are the contract's; possessive quantifiers and look-behinds only keep
Java's matcher linear on long runs and change no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Characters on each side of a span in which context words count.
CONTEXT = 48
#: A proposed span is kept at this score or above.
KEEP = 0.5

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SECRET = r"(?i)\b(?:api[_-]?key|secret|token|password|passwd)\b\x20?[=:]\x20?[\"'][A-Za-z0-9+/_=-]{16,200}[\"']"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _card_ok(m: Column) -> Column:
    return F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m))


def _ip_ok(m: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(m, r"\."), small)


def _phone_ok(m: Column) -> Column:
    return F.length(_digits(m)).between(8, 15)


def _iban_ok(m: Column) -> Column:
    """ISO 13616: with the first four characters moved to the end and letters as 10 to 35, the remainder by 97 is 1."""
    bare = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.length(bare).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


def _ssn_ok(m: Column) -> Column:
    area, group, serial = (F.substring(m, *at) for at in ((1, 3), (5, 2), (8, 4)))
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


#: kind, pattern, a text the pattern can't match without (or None), validator, score without context words, context words.
BASE = (
    ("email", EMAIL, "@", None, 1.0, None),
    ("ip", IP, ".", _ip_ok, 1.0, None),
    ("card", CARD, None, _card_ok, 1.0, None),
    ("phone", PHONE, "+", _phone_ok, 1.0, None),
)
ADDED = (
    ("iban", IBAN, None, _iban_ok, 0.7, r"(?i)\b(iban|account|bank|konto|compte|cuenta|bic|swift)\b"),
    ("ssn", SSN, "-", _ssn_ok, 0.4, r"(?i)\b(ssn|social security|taxpayer|tax id)\b"),
    ("secret", SECRET, None, None, 0.8, None),
)
#: Added to a score for context words near the span; taken off where the span is in a run of numbers.
LIFT, DROP = 0.3, 0.3


def _spans(text: Column, kind: str, pattern: str, needs: str | None, valid, score: float, near: str | None) -> Column:
    """Array of ``struct<kind, start, end, score>``, in order of start; code points, end exclusive.

    The text between matches comes from a split by the same pattern; lengths then
    give the positions, and the neighbouring parts give the context.
    """
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gap = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")

    def fold(acc: Column, x: Column) -> Column:
        m, g, h = x["m"], x["g"], x["h"]
        start = acc["at"] + F.length(g)
        end = start + F.length(m)
        grade = F.lit(score)
        if near is not None:
            before, after = F.substring(g, -CONTEXT, CONTEXT), F.substring(h, 1, CONTEXT)
            grade = grade + F.when(before.rlike(near) | after.rlike(near), LIFT).otherwise(0.0)
            grade = grade - F.when(before.rlike(r"[0-9]\x20?$") | after.rlike(r"^\x20?[0-9]"), DROP).otherwise(0.0)
        ok = (grade >= KEEP) if valid is None else (valid(m) & (grade >= KEEP))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), grade.alias("score"))
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    def spans(x: Column) -> Column:
        n = F.size(x["m"])
        rows = F.arrays_zip(x["m"].alias("m"), F.slice(x["g"], 1, n).alias("g"), F.slice(x["g"], 2, n).alias("h"))
        start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
        return F.when(n == 0, empty).otherwise(F.aggregate(rows, start, fold, lambda acc: acc["spans"]))

    # an array of one binds both arrays, so that each pattern runs over the text once
    found = F.element_at(F.transform(F.array(F.struct(match.alias("m"), gap.alias("g"))), spans), 1)
    here = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]") if kind != "secret" else text.rlike("[=:]")
    return F.when(here, found).otherwise(empty)


def find_pii(docs: DataFrame, text: str = "text", names: tuple[str, str] = ("pii_base", "pii_added")) -> DataFrame:
    """``docs`` with two columns, ``pii_base`` and ``pii_added`` unless named otherwise: arrays of ``struct<kind, start, end, score>``.

    Base kinds, in order: email, ip, card (Luhn), phone. Added kinds: iban (mod-97),
    ssn (ranges, and context words nearby), secret (a quoted value given to a key
    word). An added span that lies within a base span of its document stays out.
    Null and empty texts give empty arrays. Columns of these two names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*(_spans(body, *kind) for kind in BASE))
    added = F.concat(*(_spans(body, *kind) for kind in ADDED))
    out = docs.withColumn(names[0], base).withColumn(names[1], added)
    inside = F.filter(names[1], lambda a: ~F.exists(names[0], lambda b: (b["start"] <= a["start"]) & (b["end"] >= a["end"])))
    return out.withColumn(names[1], inside)


def spell(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``<KIND>``; overlapping spans become one, named after the first.

    Null texts stay null; the other columns stay as they are.
    """
    names = ("__pii_base", "__pii_added")
    found = find_pii(docs, text, names)
    ordered = F.array_sort(
        F.transform(F.concat(*names), lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"])),
    )
    body = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def fold(acc: Column, s: Column) -> Column:
        end = -s["back"]
        # a span that starts within what is masked already only lengthens it
        fresh = s["start"] >= acc["at"]
        gap = F.substr(body, acc["at"] + 1, s["start"] - acc["at"])
        more = F.array(gap, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.struct(F.greatest(acc["at"], end).alias("at"), F.when(fresh, F.concat(acc["parts"], more)).otherwise(acc["parts"]).alias("parts"))

    masked = F.aggregate(
        ordered, start, fold,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(body, acc["at"] + 1, F.length(body))),
    )
    clean = F.size(names[0]) + F.size(names[1]) == 0
    return found.withColumn(text, F.when(clean | body.isNull(), body).otherwise(masked)).drop(*names)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select(
        "doc_id",
        *(count(kind) for kind, *_ in BASE),
        F.sha2(spell(F.col("pii_base")), 256).alias("base_sha256"),
        spell(F.concat("pii_base", "pii_added")).alias("spans"),
    )


QUERIES = {"op1_pii": op1_pii}
ORACLE_SQL: dict[str, str] = {}
