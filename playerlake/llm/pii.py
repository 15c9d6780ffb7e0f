"""Personal data by patterns, checksums and context, DataFrame operations only.

Regular expressions propose spans, checksum validators (Luhn, mod 97, number
ranges) confirm them, and words just before a span adjust its score. A text is
split by each pattern, and the lengths of matches and of the text between them
give the positions, in code points with exclusive ends. Patterns are anchored at
the start of a run, so no pattern rescans a long run.

Kinds: email, ip, card and phone are the base ones, kept by their validators
alone. iban must pass mod 97 at its country's length; its pattern finds only the
head, so words or another IBAN after it don't hide the end. A country code without
a fixed length may end after any group. token (a long run of letters and digits) and
account (a bare number) have no checksum and are kept only where context words
raise their score to ``THRESHOLD``.

Defined results: null or empty text has no spans; repeated rows are rows; extra
columns pass through, one named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
#: Characters before a span, back to the last match of its kind at most.
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3

#: Kind, pattern, and the score before context. The order breaks ties of equal starts.
KINDS = [
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 1.0),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 1.0),
    ("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", 1.0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 1.0),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})", 1.0),
    ("token", r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{20,}+", 0.3),
    ("account", r"(?<![A-Za-z0-9.+-])[0-9]{6,11}+(?![A-Za-z0-9@-]|\.[0-9])", 0.3),
]
BASE = ["email", "ip", "card", "phone"]
#: Words that, shortly before a span, make it likelier to be of the kind.
CONTEXT = {
    "token": r"(?i)\b(?:token|secret|password|passwd|api[_ -]?key|key|bearer)\b",
    "account": r"(?i)\b(?:account|acct|konto|compte|cuenta|iban|ssn|passport|ausweis)\b",
}
#: The length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Characters of the longest IBAN with a space before each character after its head.
IBAN_CHARS = 64
#: A cheap test that a text can hold the kind at all.
NEEDS = {"email": "@", "phone": "+"}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return (F.length(_digits(match)) <= 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "))
        turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
        # mod 97 digit by digit; a letter stands for two digits
        rest = F.aggregate(
            F.filter(F.split(turned, ""), lambda c: c != ""),
            F.lit(0),
            lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
        )
        return F.length(plain).between(15, 34) & (rest == 1)
    return F.lit(True)


def _iban_length(near: Column) -> Column:
    """Characters, spaces included, of the IBAN that ``near`` starts with; null for none."""
    known = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for code in codes.split() for x in (code, n)])
    wanted = F.try_element_at(known, F.substring(near, 1, 2))

    def admissible(n: Column) -> Column:
        part = F.substring(near, 1, n)
        size = F.length(F.replace(part, F.lit(" ")))
        whole = (F.length(part) == n) & part.rlike(r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}$") & ~F.substring(near, n + 1, 1).rlike("[A-Za-z0-9]")
        return whole & (size == F.coalesce(wanted, size)) & _valid("iban", part)

    return F.array_max(F.filter(F.sequence(F.lit(15), F.lit(IBAN_CHARS)), admissible))


def _spans(text: Column, number: int, kind: str, pattern: str, score: float) -> Column:
    """Array of (start, kind, end, name, score) of the confirmed matches of one kind."""
    struct = "array<struct<start:int,kind:int,end:int,name:string,score:double>>"
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))

    def walk(acc: Column, step: Column) -> Column:
        start = acc["at"] + F.length(step["gap"])
        at = end = start + F.length(step["match"])
        if kind == "iban":  # a group inside an IBAN can look like a head
            end = F.when(start >= acc["until"], start + _iban_length(F.substring(text, start + 1, IBAN_CHARS + 1)))
            good = end.isNotNull()
        else:
            good = _valid(kind, step["match"])
        total = F.lit(score)
        if kind in CONTEXT:
            near = F.substring(step["gap"], -CONTEXT_CHARS, CONTEXT_CHARS).rlike(CONTEXT[kind])
            total = total + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), F.lit(kind).alias("name"), total.alias("score"))
        found = F.when(good & (total >= THRESHOLD), F.concat(acc["found"], F.array(span).cast(struct))).otherwise(acc["found"])
        return F.struct(at.alias("at"), F.coalesce(end, acc["until"]).alias("until"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("until"), F.array().cast(struct).alias("found"))
    test = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike(pattern)
    if kind in CONTEXT:
        test = text.rlike(CONTEXT[kind]) & test
    return F.when(test, F.aggregate(steps, start, walk)["found"]).otherwise(F.array().cast(struct))


def find_pii(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii``: all spans by start, then kind, then end."""
    df = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "pii"])
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.withColumn("pii", F.array_sort(F.concat(*[_spans(text, k, *kind) for k, kind in enumerate(KINDS)])))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by <KIND>; overlapping spans become one, named by the first."""
    df = find_pii(docs, text_col=text_col)
    text = F.col(f"`{text_col}`")
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    walked = F.aggregate(
        "pii",
        state,
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("<"), F.upper(s["name"]), F.lit(">")))).alias("out"),
        )).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
    )
    clean = F.concat(F.array_join(walked["out"], ""), F.substring(text, walked["at"] + 1, F.length(text)))
    return df.withColumn(text_col, F.when(F.size("pii") > 0, clean).otherwise(text))
