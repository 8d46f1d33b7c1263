"""PII (operator 1): patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only: a scan of the documents with two columns, no shuffle and no Python.

Kinds, in the order in which spans of one start are listed:
* email, ip, card, phone - the base. Matches are leftmost and don't overlap within a kind; one that fails its
  check (parts of an ip over 255, a card's Luhn sum or digits, a phone's digits) is dropped and not tried anew.
* iban - a country code, two check digits and as many more signs as the country has, passing mod-97.
* local - a national phone number without "+": 7 to 15 digits. It has no checksum, so that only a context
  word close before it lifts it over the threshold.
* secret - a run of 20 signs or more as of keys and tokens, after "=" too, with digits and letters and at least DISTINCT different signs
  (what is long and orderly is no secret). Checksums of files look the same, so that only a context word makes it one.

A span's score is its kind's prior, which the checksum has raised, plus CONTEXT_BONUS where a context word
of its kind is among the CONTEXT_CHARS characters before it. Base spans always stay; the others need THRESHOLD.

Offsets are code points, the end exclusive. The patterns are possessive and start at the first sign of a run
(or at the end of the match before), so that time is linear in the text.

Cases: a null text is empty and has no spans. Very long texts are searched whole. Each row is returned, with
null or repeated ids as well; an empty table gives no rows. Other columns stay as they are; one named ``pii`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "local", "secret")
BASE = 4
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: How long an IBAN of each country is.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
#: Different signs that a secret has at least.
DISTINCT = 9
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{IBAN})(?![A-Za-z0-9])",
    "local": r"(?<![A-Za-z0-9.+-])\(?[0-9]{2,4}\)?(?:[ /-]?[0-9]{2,4}){2,4}+(?![A-Za-z0-9.-]|[ /-][0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])",
}
#: Context words in the four languages of the corpus.
CONTEXT = {
    "email": "e-?mail|mail|correo|courriel",
    "ip": "ip|host|server|address|adresse|dirección",
    "card": "card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta",
    "phone": "phone|tel|telephone|mobile|call|fax|telefon|téléphone|teléfono|móvil",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "local": "phone|tel|telephone|mobile|call|fax|telefon|téléphone|teléfono|móvil",
    "secret": "token|secret|key|apikey|password|passwd|pwd|auth|authorization|bearer|credentials?|schlüssel|passwort|kennwort|clé|jeton|mot de passe|clave|contraseña",
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.7, "local": 0.3, "secret": 0.3}
CONTEXT_BONUS, CONTEXT_CHARS, THRESHOLD = 0.25, 32, 0.5
#: One rule for all uses: a context word of a kind, in any case of any script, without a letter next to it.
WORDS = {kind: rf"(?iu)(?<!\p{{L}})(?:{words})(?!\p{{L}})" for kind, words in CONTEXT.items()}
_OPEN, _CLOSE, _OTHER = "\u0001", "\u0002", "\u0003"
_SPAN = "array<struct<start:int,k:int,stop:int,score:double>>"


def _matches(text: Column, pattern: str) -> Column:
    """Every match of a pattern as (start, stop, hit): marks are set around the matches and the parts' lengths summed."""
    parts = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]", -1)

    def step(acc: Column, part: Column) -> Column:
        stop = acc["at"] + F.length(part)
        hit = F.array(F.struct(acc["at"].alias("start"), stop.alias("stop"), part.alias("hit")))
        return F.struct(stop.alias("at"), (~acc["inside"]).alias("inside"), F.when(acc["inside"], F.concat(acc["out"], hit)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast("array<struct<start:int,stop:int,hit:string>>").alias("out"))
    return F.aggregate(parts, zero, step, lambda acc: acc["out"])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _mod97(hit: Column) -> Column:
    """Whether an IBAN's number, its first four signs moved to the end and letters as 10 to 35, is 1 mod 97."""
    plain = F.regexp_replace(hit, " ", "")
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), plain.substr(1, 4))
    signs = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(turned.substr(i, F.lit(1))))
    rest = F.aggregate(signs, F.lit(0), lambda acc, c: F.when(c >= 65, acc * 100 + (c - 55)).otherwise(acc * 10 + (c - 48)) % 97)
    return rest == 1


def _valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: hit.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "card": lambda: n.between(12, 19) & F.call_function("luhn_check", _digits(hit)),
        "phone": lambda: n.between(9, 15),
        "iban": lambda: F.length(F.regexp_replace(hit, " ", "")).between(15, 34) & _mod97(hit),
        "local": lambda: n.between(7, 15),
        "secret": lambda: hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(hit, ""))) >= DISTINCT),
    }[kind]()


def _likely(kind: str, text: Column) -> Column:
    """A quick test that is true of every text with a match of the kind."""
    return {
        "email": lambda: text.contains("@"),
        "ip": lambda: text.rlike(r"[0-9]\.[0-9]"),
        "card": lambda: text.rlike("[0-9][ -]?[0-9]"),
        "phone": lambda: text.contains("+"),
        "iban": lambda: text.rlike("[A-Z]{2}[0-9]{2}"),
        "local": lambda: text.rlike("[0-9]{2}") & text.rlike(WORDS["local"]),
        "secret": lambda: text.rlike(WORDS["secret"]) & text.rlike("[A-Za-z0-9+/_-]{20}"),
    }[kind]()


def _spans(kind: str, text: Column) -> Column:
    k = KINDS.index(kind)
    found = F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["hit"]))

    def scored(m: Column) -> Column:
        begin = F.greatest(F.lit(0), m["start"] - CONTEXT_CHARS)
        before = text.substr(begin + 1, m["start"] - begin)
        bonus = F.when(before.rlike(WORDS[kind]), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(m["start"].alias("start"), F.lit(k).alias("k"), m["stop"].alias("stop"), (F.lit(PRIOR[kind]) + bonus).alias("score"))

    out = F.transform(found, scored)
    if k >= BASE:
        out = F.filter(out, lambda s: s["score"] >= THRESHOLD)
    return F.when(_likely(kind, text), out).otherwise(F.array()).cast(_SPAN)


def find_pii(documents: DataFrame) -> DataFrame:
    """The documents with ``pii``: an array of (start, k, stop, score) by start and kind, k the place of the kind in KINDS."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = text.contains(_OPEN) | text.contains(_CLOSE)
    # The marks may not be in the text; what stands in for them is in no pattern either and as long.
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row")
    out = documents.select(row, F.when(marked, F.translate(text, _OPEN + _CLOSE, _OTHER * 2)).otherwise(text).alias("_text"))
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", _spans(kind, F.col("_text")))
    # A local number inside a base span is that span's.
    base = F.concat(*(F.col(f"_{k}") for k in KINDS[:BASE]))
    inside = F.filter("_local", lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    out = out.select("_row", F.array_sort(F.concat(base, F.col("_iban"), inside, F.col("_secret"))).alias("_pii"))
    return out.select(*(F.col(f"_row.`{c}`") for c in documents.columns if c != "pii"), F.col("_pii").alias("pii"))


def kind_name(k: Column) -> Column:
    return F.element_at(F.array(*(F.lit(x) for x in KINDS)), k + 1)


def is_kind(kind: str):
    """A condition on a span, for filter()."""
    return lambda s: s["k"] == KINDS.index(kind)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["k"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(documents: DataFrame) -> DataFrame:
    """The documents, each span of ``text`` replaced by its kind in brackets (overlapping ones by the first); a null text stays null."""

    def step(acc: Column, s: Column) -> Column:
        text = F.col("text")
        fresh = s["start"] >= acc["at"]
        more = F.concat(acc["out"], F.when(fresh, F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(kind_name(s["k"])), F.lit("]"))).otherwise(""))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), more.alias("out"))

    masked = F.aggregate("pii", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    # The row is kept apart, so that no column of it clashes with one made here.
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"), F.col("text").cast("string").alias("text"))
    found = find_pii(rows).withColumn("text", F.when(F.size("pii") > 0, masked).otherwise(F.col("text")))
    return found.select(*(F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in documents.columns))
