"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

``find_pii`` adds an array column of spans (code points, end exclusive). The four base kinds are reported
whenever their pattern and check hold; the further kinds only when their score, after the words nearby, reaches
``threshold``. Null and empty texts have no spans. Every row gives one row, repeated rows included; a column of
the input that has the name of the result column is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BASE_KINDS = ("email", "ip", "card", "phone")
#: Reported after the base kinds, in this order.
MORE_KINDS = ("iban", "short_card", "national_id", "local_phone")
KINDS = BASE_KINDS + MORE_KINDS
SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                  ("score", pa.float64())]))

# Each pattern below finds the same spans as the plain form in its comment, in time linear in the text.
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+); a digit run can only match from its start
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
# [0-9]([\x20-]?[0-9])+
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
# \+[0-9][\x20().0-9-]+[0-9]
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
# [A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30} between word ends; of its ends, that of the country's length
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){0,30}")
_GROUP, _WORD = re.compile(r"[A-Z0-9]+"), re.compile(r"[A-Za-z0-9]")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")

#: Characters of an IBAN by country (ISO 13616 registry).
IBAN_LENGTH = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

#: Score before context, and the words that raise or lower it within ``window`` characters.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "short_card": 0.4, "national_id": 0.4,
         "local_phone": 0.4}
RAISING = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|client)\b"),
    "card": re.compile(r"(?i)\b(?:card|credit|debit|visa|mastercard|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|bank|account|konto|transfer)\b"),
    "short_card": re.compile(r"(?i)\b(?:card|credit|debit|amex|payment)\b"),
    "national_id": re.compile(r"(?i)\b(?:ssn|social security|national id|tax id)\b"),
    "local_phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax)\b"),
}
LOWERING = re.compile(r"(?i)\b(?:version|example|sample|isbn|serial|order no)\b")
RAISE, LOWER, WINDOW, THRESHOLD = 0.4, 0.2, 40, 0.6


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    at, after = text.find("@"), 0
    while at >= 0:
        found = _DOMAIN.match(text, at)
        start = at
        if found:
            while start > after and text[start - 1] in _LOCAL:
                start -= 1
        if found and start < at:
            yield start, found.end()
            after = found.end()
        at = text.find("@", max(after, at + 1))


def _octets(found: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in found.split("."))


def _short_cards(text: str, start: int, end: int):
    """13-15 digits with a right checksum, from the start to the end of digit groups of the run ``start``..``end``.

    From each start the longest; a span inside one before it is left out.
    """
    groups, covered = [m.span() for m in _DIGITS.finditer(text, start, end)], 0
    for i, (first, _) in enumerate(groups):
        digits, fits = "", []
        for a, b in groups[i:i + 15]:
            if len(digits) + b - a > 15:
                break
            digits += text[a:b]
            if len(digits) >= 13:
                fits.append((b, digits))
        for last, digits in reversed(fits):
            if last > covered and luhn(digits):
                yield first, last
                covered = last
                break


def _ibans(text: str) -> list[tuple[int, int]]:
    """IBANs of their country's length; between them, of countries not in the registry, the longest that end with a group."""
    known, other = [], []
    for m in _IBAN_START.finditer(text):
        start, wanted = m.start(), IBAN_LENGTH.get(m[0][:2])
        plain, fits = "", []
        for g in _GROUP.finditer(text, start, _IBAN_REST.match(text, m.end()).end()):
            plain += g[0]
            if not _WORD.match(text, g.end()) and (len(plain) == wanted if wanted else 15 <= len(plain) <= 34):
                fits.append((g.end(), plain))
        found = known if wanted else other
        for last, plain in reversed(fits):
            if mod97(plain) and (not found or last > found[-1][1]):
                found.append((start, last))
                break
    ends = [last for _, last in known]
    between = [(start, last) for start, last in other
               if (i := bisect_right(ends, start)) == len(known) or known[i][0] >= last]
    return sorted([*known, *between])


def proposals(text: str) -> dict[str, list[tuple[int, int]]]:
    """Confirmed spans by kind, before scoring."""
    out = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = list(_emails(text))
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out["ip"] = [m.span() for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if len(m[0]) < 13:
            continue
        digits = _NO_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
        else:
            out["short_card"].extend(_short_cards(text, *m.span()))
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    out["iban"] = _ibans(text)
    out["national_id"] = [m.span() for m in _NATIONAL.finditer(text)]
    out["local_phone"] = [m.span() for m in _LOCAL_PHONE.finditer(text)]
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}"
    value = PRIOR[kind] + RAISE * bool(RAISING[kind].search(near)) - LOWER * bool(LOWERING.search(near))
    return round(min(1.0, max(0.0, value)), 3)


def spans_of(text: str | None, threshold: float = THRESHOLD) -> list[dict]:
    """All spans of one text, by kind in the order of ``KINDS``, then by start."""
    rows = []
    for kind, spans in proposals(text or "").items():
        for start, end in spans:
            value = score(text, kind, start, end)
            if kind in BASE_KINDS or value >= threshold:
                rows.append({"kind": kind, "start": start, "end": end, "score": value})
    return rows


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii", threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``out``: array of (kind, start, end, score)."""
    @F.arrow_udf(SPAN_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([spans_of(t, threshold) for t in texts.to_pylist()], _ARROW_SPAN)

    return docs.withColumn(out, spans(F.col(text)))


def redact(docs: DataFrame, text: str = "text", pii: str = "pii") -> DataFrame:
    """Replaces every span by its kind in brackets; of overlapping spans the union becomes one, of the first kind."""
    @F.arrow_udf("string")
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if t is not None and found:
                parts, at = [], 0
                for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [t[at:s["start"]], f"[{s['kind'].upper()}]"]
                    at = max(at, s["end"])
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    return docs.withColumn(text, masked(F.col(text), F.col(pii)))


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    of = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[of(k) for k in BASE_KINDS], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("pii")).alias("spans"))
