"""Personal data spans: regular expressions propose, checksums confirm, context words score (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length of an account number by country (fixed values of ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
#: Proposals by kind, in the order in which spans at the same place are listed. They match what the plain patterns of the
#: contract match; look-behinds and possessive repeats keep the search linear in runs of like characters.
EMAIL_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{EMAIL_LOCAL}]))[{EMAIL_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: A cheap condition that any text with a match meets.
HINTS = {"email": "%@%.%", "ip": "%.%.%.%", "card": None, "phone": "%+%", "iban": None, "ssn": "%-%-%"}
#: Score without context, and the words that raise it when they stand near.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|address|server|host",
    "card": "card|visa|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|transfer",
    "ssn": r"social|security|\bssn\b|taxpayer",
}
CONTEXT_BONUS, CONTEXT_CHARS, LEAST_SCORE = 0.25, 40, 0.5
#: Matches that are placed in one fold; the work is linear in the matches of a text up to the square of its folds.
MATCHES_A_FOLD = 64
SPANS = "array<struct<start:int,rank:int,end:int,m:string,near:string>>"


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = F.regexp_replace(m, "[ -]", "")
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(10, 15)
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
        value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise((a * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97))
        return rest == 1
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9..)|-00-|-0000$")
    return F.lit(True)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its personal data spans.

    Kinds ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are always reported where their pattern and check hold; ``iban``
    (mod-97, the country's length) and ``ssn`` are added where base score plus the bonus for a context word reaches 0.5. Context
    is 40 characters on either side, as far as the next match of the pattern.
    Offsets are code points, end exclusive. Null text counts as empty; repeated rows and ids stay as they are; an empty table
    gives no rows; other columns are not looked at. Columns: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans,
    scores (kind:start:score of all spans).
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    plain = plain.withColumn("digits", F.col("t").rlike("[0-9](?:[^0-9\n]{0,3}[0-9]){6}|[0-9]\\.[0-9]"))
    none = F.array().cast("array<string>")
    found = plain
    for kind, pattern in PATTERNS.items():
        hint = F.lit(True) if HINTS[kind] is None else F.col("t").like(HINTS[kind])
        if kind in ("ip", "card", "ssn"):
            hint = F.col("digits") & hint
        found = found.withColumn(f"m_{kind}", F.when(hint, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none))
    located = found
    for kind, pattern in PATTERNS.items():
        located = located.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split("t", pattern, -1)).otherwise(none))

    def folds_of(kind: str) -> Column:
        m, g = F.col(f"m_{kind}"), F.col(f"g_{kind}")
        beside = lambda i: F.lower(F.concat(F.substring(g[i], -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "), F.substring(g[i + 1], 1, CONTEXT_CHARS)))
        parts = F.transform(m, lambda x, i: F.struct(F.length(g[i]).alias("gap"), F.length(x).alias("own"), x.alias("m"), beside(i).alias("near")))
        folds = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / MATCHES_A_FOLD).cast("int")), lambda i: F.slice(parts, i * MATCHES_A_FOLD + 1, F.lit(MATCHES_A_FOLD)))
        return F.when(F.size(m) > 0, folds).otherwise(F.array().cast("array<array<struct<gap:int,own:int,m:string,near:string>>>"))

    def placed(rank: int, kind: str) -> Column:
        folds = F.col(f"f_{kind}")
        length = lambda fold: F.aggregate(fold, F.lit(0), lambda a, x: a + x["gap"] + x["own"])
        begins = F.aggregate(F.transform(folds, length), F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))

        def spans(fold: Column, begin: Column) -> Column:
            step = lambda a, x: F.struct(
                (a["at"] + x["gap"] + x["own"]).alias("at"),
                F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), (a["at"] + x["gap"] + x["own"]).alias("end"), x["m"].alias("m"), x["near"].alias("near")))).alias("out"),
            )
            return F.aggregate(fold, F.struct(begin.alias("at"), F.array().cast(SPANS).alias("out")), step, lambda a: a["out"])

        every = F.flatten(F.zip_with(folds, F.slice(begins, 1, F.size(folds)), spans))
        return F.filter(F.when(F.size(folds) > 0, every).otherwise(F.array().cast(SPANS)), lambda s: _confirmed(kind, s["m"]))

    folded = located.select("doc_id", *[folds_of(k).alias(f"f_{k}") for k in PATTERNS])
    listed = folded.select("doc_id", *[placed(i, k).alias(f"s_{k}") for i, k in enumerate(PATTERNS)])

    def scored(kind: str) -> Column:
        bonus = lambda s: F.when(s["near"].rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        full = F.transform(F.col(f"s_{kind}"), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), (F.lit(SCORES[kind]) + bonus(s)).alias("score")))
        return full if kind in BASE_KINDS else F.filter(full, lambda s: s["score"] >= LEAST_SCORE)

    weighed = listed.select("doc_id", *[scored(k).alias(f"s_{k}") for k in PATTERNS])
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in PATTERNS]), s["rank"] + 1)
    join = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
    ordered = weighed.select(
        *["doc_id", *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS]],
        F.array_sort(F.concat(*[F.col(f"s_{k}") for k in BASE_KINDS])).alias("base"),
        F.array_sort(F.concat(*[F.col(f"s_{k}") for k in PATTERNS])).alias("every"),
    )
    return ordered.select(
        *["doc_id", *[f"n_{k}" for k in BASE_KINDS]],
        F.sha2(join(F.col("base")), 256).alias("base_sha256"),
        join(F.col("every")).alias("spans"),
        F.array_join(F.transform("every", lambda s: F.concat_ws(":", name(s), s["start"], F.format_number(s["score"], 2))), ",").alias("scores"),
    )
