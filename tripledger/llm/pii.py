"""Personal data in texts, in DataFrame functions only.

Regular expressions propose spans of each kind, leftmost first and without overlaps within a
kind. Validators confirm them: the range of address parts, Luhn for card numbers, mod-97 for bank
accounts, the number of digits for phones. A span's score starts from its kind and is adjusted by
words near it. Kinds of ``ALWAYS`` stay whatever their score; the others need ``threshold``.

The expressions are written so that a scan takes time in proportion to the text: quantifiers are
possessive and a run of characters is tried from its start only (or from the end of the match
before), neither of which changes what matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import full_text
from tripledger.llm.spans import spans

LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])",
}
# What a text must contain before an expression is tried on it.
GATES = {"email": "@", "phone": "+", "ssn": "-"}
ALWAYS = ("email", "ip", "card", "phone")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3, "secret": 0.3}
FOR = {
    "email": "mail|contact|write|address",
    "ip": r"\bip\b|address|host|server|client",
    "card": "card|visa|master|credit|debit|payment|carte|karte|tarjeta",
    "phone": r"phone|call|\btel\b|mobile|fax|contact",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social|security|tax\b|taxpayer",
    "secret": r"token|secret|password|passwd|\bkey\b|api.?key|credential|bearer",
}
AGAINST = r"example|version|release|checksum|sha256|sha1|md5|commit|order no|invoice no"
AROUND = 48
# After the leading zeros nothing more may come: then the part is zero.
PART = "0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|(?<=0))"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def mod97(text: Column) -> Column:
    """Remainder of a bank account number (ISO 7064): the first four characters go last, letters
    count as 10 to 35."""
    code = F.upper(F.regexp_replace(text, " ", ""))
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.ascii(c))
    return F.aggregate(F.filter(values, lambda v: v > 0), F.lit(0), lambda acc, v: F.when(
        v >= 65, (acc * 100 + v - 55) % 97).otherwise((acc * 10 + v - 48) % 97))


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        size = F.length(_digits(match))
        return size.between(16, 19) & F.when(size.between(16, 19), F.call_function("luhn_check", _digits(match)))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & (mod97(match) == 1)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Fa-f]")
    return F.lit(True)


def score(kind: str, span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    found = (F.lit(PRIOR[kind]) + F.when(near.rlike(FOR[kind]), 0.35).otherwise(0.0)
             - F.when(near.rlike(AGAINST), 0.2).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), found))


def find(docs: DataFrame, threshold: float = 0.5, kinds: tuple[str, ...] = tuple(PATTERNS)
         ) -> DataFrame:
    """``doc_id`` and ``found``, an array of structs ``kind``, ``start``, ``end``, ``match``,
    ``score``, by kind as listed in ``PATTERNS`` and then by start, for every row.

    Null and empty texts have an empty array; repeated rows are repeated. Whole texts are
    scanned. An empty table gives no rows.
    """
    shape = "array<struct<kind:string,start:bigint,end:bigint,match:string,score:double>>"
    text, none = F.col("text"), F.array().cast("array<string>")
    rows = docs.select("doc_id", full_text().alias("text"))
    rows = rows.withColumns({f"_{k}": F.when(
        F.contains(text, F.lit(GATES[k])) if k in GATES else text.rlike("[0-9]"),
        F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none) for k in kinds})
    def confirmed(kind: str) -> Column:
        matches = F.col(f"_{kind}")
        pieces = F.split(text, PATTERNS[kind], -1)
        good = F.filter(spans(matches, pieces, AROUND), lambda s: valid(kind, s["match"]))
        scored = F.transform(good, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["match"].alias("match"), score(kind, s).alias("score")))
        if kind not in ALWAYS:
            scored = F.filter(scored, lambda s: s["score"] >= threshold)
        # Most matches of digits are no card: only texts with a valid one need the places.
        worth = F.exists(matches, lambda m: valid(kind, m))
        return F.when(worth, scored.cast(shape)).otherwise(F.array().cast(shape))

    return rows.select("doc_id", F.concat(*map(confirmed, kinds)).alias("found"))
