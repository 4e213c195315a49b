"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Only DataFrame expressions run here. For each kind a regular expression
proposes leftmost non-overlapping spans (``regexp_extract_all`` gives the
matches, ``split`` the text between them, so the running length gives code-point
offsets). Validators then drop matches: parts of an IP address above 255,
card numbers that fail Luhn, phone numbers outside 9 to 15 digits, IBANs that
fail mod 97. An IBAN is proposed at every group of characters that begins like
one: the part as long as its country's IBANs, else all that could belong to it.
Each remaining span has a score in percent: a prior of its kind,
plus 30 when a checksum confirmed it, plus 20 when a context word of the kind
stands in the 48 code points before it. Base kinds always stay; added kinds
(iban, ssn) need 60, so a social-security pattern counts only with context.

The patterns use possessive repeats and guarded starts: they match the same
spans as the plain forms, in linear time and without recursion, so a text that
is one long run of digits or letters is safe.

Defined results: null text is empty text; text without matches gives empty
lists; repeated rows are treated alike; an empty table gives no rows; other
columns pass untouched (columns named like the outputs are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shield

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
ACCEPT = 60
CONTEXT_CHARS = 48

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # the head of a number; what may follow is looked at, not taken
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}))",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
#: A cheap test that a text without a match fails.
_HINT = {"email": "@", "phone": "+", "ip": ".", "ssn": "-"}
PRIOR = {"email": 70, "ip": 50, "card": 40, "phone": 50, "iban": 40, "ssn": 40}
CHECKSUM = {"card", "iban"}
CONTEXT = {
    "email": "mail|contact|write to",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile",
    "iban": "iban|account|bank",
    "ssn": "ssn|social security",
}
# Characters of an IBAN by country code.
IBAN_LENGTH = {country: int(n) for n, countries in {
    "15": "NO", "16": "BE", "18": "DK FI FK FO GL NL SD", "19": "MK SI",
    "20": "AT BA EE KZ LT LU MN XK", "21": "CH HR LI LV",
    "22": "BG BH CR DE GB GE IE ME RS VA", "23": "AE GI IL IQ OM SO TL",
    "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST", "26": "IS TR",
    "27": "BI DJ FR GR IT MC MR SM", "28": "AL AZ BY CY DO GT HN HU LB NI PL SV",
    "29": "BR EG PS QA UA", "30": "JO KW MU YE", "31": "MT SC", "32": "LC", "33": "RU",
}.items() for country in countries.split()}
_SPAN = "struct<kind:string,start:long,end:long,match:string>"
_CHUNK = 256


def _fold(items: Column, start: Column, kind: str) -> Column:
    """Running offsets over (gap length, match length, match)."""
    zero = F.struct(start.alias("pos"), F.array().cast(f"array<{_SPAN}>").alias("got"))
    return F.aggregate(items, zero, lambda acc, x: F.struct(
        (acc["pos"] + x["gap"] + x["len"]).alias("pos"),
        F.concat(acc["got"], F.array(F.struct(
            F.lit(kind).alias("kind"), (acc["pos"] + x["gap"]).alias("start"),
            (acc["pos"] + x["gap"] + x["len"]).alias("end"), x["match"].alias("match"))))
        .alias("got")))


def _spans(matches: Column, gaps: Column, kind: str) -> Column:
    """Spans with code-point offsets; chunked, so many matches cost no square."""
    items = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(
        F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("len"),
        m.alias("match")))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _CHUNK).cast("int")),
        lambda c: F.slice(items, c * _CHUNK + 1, _CHUNK))
    zero = F.struct(F.lit(0).cast("long").alias("pos"),
                    F.array().cast(f"array<array<{_SPAN}>>").alias("parts"))
    folded = F.aggregate(chunks, zero, lambda acc, c: F.transform(
        F.array(_fold(c, acc["pos"], kind)), lambda r: F.struct(
            r["pos"].alias("pos"), F.concat(acc["parts"], F.array(r["got"])).alias("parts")))[0])
    return F.flatten(folded["parts"])


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _mod97(compact: Column) -> Column:
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def add(acc, c):
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise(
            (acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(
        c == "", acc).otherwise(add(acc, c))) == 1


def _alone(text: Column, s: Column, chars: str) -> Column:
    """No character of ``chars`` directly before or after the span."""
    before = F.when(s["start"] > 0, F.substring(text, s["start"].cast("int"), F.lit(1))).otherwise("")
    after = F.substring(text, (s["end"] + 1).cast("int"), F.lit(1))
    return ~before.rlike(f"[{chars}]") & ~after.rlike(f"[{chars}]")


def _valid(kind: str, text: Column, s: Column) -> Column:
    m = s["match"]
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
            "^(|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = F.translate(m, " -", "")
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        compact = F.translate(m, " ", "")
        return _alone(text, s, "A-Za-z0-9") & F.length(compact).between(15, 34) & _mod97(compact)
    if kind == "ssn":
        return _alone(text, s, "0-9-")
    return F.lit(True)


def _ibans(text: Column, heads: Column, tails: Column) -> Column:
    """Valid spans from the spans of IBAN heads and what may follow each: of a number
    the part of its country's length, else all of it; none inside another."""
    sizes = F.create_map(*[F.lit(x) for pair in IBAN_LENGTH.items() for x in pair])

    def span(s, match):
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                        (s["start"] + F.length(match)).alias("end"), match.alias("match"))

    def proposed(s, tail):
        whole = F.concat(s["match"], tail)
        size = F.element_at(sizes, F.substring(s["match"], 1, 2))
        own = F.regexp_substr(whole, F.concat(F.lit("^(?:\\x20?[A-Z0-9]){"), size.cast("string"), F.lit("}")))
        both = F.filter(F.array(own, whole), lambda m: m.isNotNull())
        return F.slice(F.filter(F.transform(both, lambda m: span(s, m)),
                                _per_span(_valid, "iban", text)), 1, 1)

    got = F.flatten(F.zip_with(heads, tails, proposed))
    return F.transform(F.array(got), lambda a: F.filter(a, lambda s, i: (i == 0) | (
        s["start"] >= F.get(a, i - 1)["end"])))[0]


def _score(kind: str, text: Column, s: Column) -> Column:
    start = s["start"].cast("int")
    near = F.substring(text, F.greatest(start - CONTEXT_CHARS + 1, F.lit(1)),
                       F.least(start, F.lit(CONTEXT_CHARS)))
    points = PRIOR[kind] + (30 if kind in CHECKSUM else 0)
    return F.lit(points) + F.when(F.lower(near).rlike(CONTEXT[kind]), 20).otherwise(0)


def _with_score(kind: str, text: Column, s: Column) -> Column:
    return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                    _score(kind, text, s).alias("score"))


def _of_kind(kind: str, _text, s: Column) -> Column:
    return s["kind"] == kind


def _per_span(rule, kind: str, text):
    """``rule`` as a function of the span alone."""
    return lambda s: rule(kind, text, s)


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end, score), by kind, then start."""
    kinds = (*BASE_KINDS, *ADDED_KINDS)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = docs.drop("spans").withColumn("__t", text)
    t = F.col("__t")
    none = F.array().cast("array<string>")

    def hinted(kind, found):
        return F.when(F.contains(t, F.lit(_HINT[kind])), found).otherwise(none) \
            if kind in _HINT else found

    docs = docs.withColumns({f"__m_{k}": hinted(k, F.regexp_extract_all(
        t, F.lit(PATTERNS[k]), F.lit(0))) for k in kinds})
    docs = docs.withColumns({f"__g_{k}": F.when(
        F.size(f"__m_{k}") > 0, F.split(t, PATTERNS[k], -1)).otherwise(none) for k in kinds})

    def valid(kind):
        spans = _spans(F.col(f"__m_{kind}"), F.col(f"__g_{kind}"), kind)
        if kind == "iban":
            return _ibans(t, spans, F.regexp_extract_all(t, F.lit(PATTERNS[kind]), F.lit(1)))
        return F.filter(spans, _per_span(_valid, kind, t))

    docs = docs.withColumns({f"__s_{k}": F.when(F.size(f"__m_{k}") > 0, valid(k)).otherwise(
        F.array().cast(f"array<{_SPAN}>")) for k in kinds})
    scored = [F.transform(F.col(f"__s_{k}"), _per_span(_with_score, k, t)) for k in kinds]
    kept = [c if k in BASE_KINDS else F.filter(c, lambda s: s["score"] >= ACCEPT)
            for k, c in zip(kinds, scored, strict=True)]
    out = docs.withColumn("spans", F.concat(*kept))
    return out.drop("__t", *[f"__{x}_{k}" for x in "mgs" for k in kinds])


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, hash of the base spans, all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.size(F.filter("spans", _per_span(_of_kind, k, None))).cast("long").alias(f"n_{k}")
              for k in BASE_KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; overlapping spans merge into
    the first one's. ``chars_col``, if there, is the new text's length in code
    points for the rows that changed. All other columns, whatever their names, and all
    rows stay as they are."""
    docs, restore = shield(docs, ("spans",))
    cols = docs.columns
    found = find(docs, text_col)
    t = F.col(f"`{text_col}`")
    order = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    cut = "struct<start:long,end:long,kind:string>"
    # spans that begin inside an earlier one extend it: keep starts, then the furthest end
    zero = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast("array<string>").alias("out"),
                    F.array().cast("array<array<string>>").alias("done"))

    def piece(acc, s):
        fresh = s["start"] >= acc["pos"]
        gap = F.substring(t, (acc["pos"] + 1).cast("int"), (s["start"] - acc["pos"]).cast("int"))
        more = F.when(fresh, F.array(F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]")))
                      ).otherwise(F.array().cast("array<string>"))
        full = F.size(acc["out"]) >= _CHUNK
        return F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(full, more).otherwise(F.concat(acc["out"], more)).alias("out"),
            F.when(full, F.concat(acc["done"], F.array(acc["out"]))).otherwise(acc["done"])
            .alias("done"))

    made = F.aggregate(order.cast(f"array<{cut}>"), zero, piece, lambda acc: F.concat(
        F.array_join(F.flatten(acc["done"]), ""), F.array_join(acc["out"], ""),
        F.substring(t, (acc["pos"] + 1).cast("int"), F.length(t))))
    found = found.withColumn("__new", F.when(F.size("spans") > 0, made).otherwise(t))
    out = []
    for c in cols:
        if c == text_col:
            out.append(F.col("__new").alias(c))
        elif c == chars_col:
            kind = docs.schema[c].dataType
            out.append(F.when(F.size("spans") > 0, F.length("__new").cast(kind))
                       .otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return restore(found.select(*out))
