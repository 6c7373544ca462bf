"""Secret scans: a keyword automaton, anchored expressions near its hits, and the checksums that secrets carry.

One pass of an Aho-Corasick automaton over a text finds every keyword of every rule.  Only there a rule's expression is tried, anchored
at the keyword, so no expression ever searches a text.  Cards and IBANs need no word before them: their issuer's digits and their
country code are keywords themselves.  What an expression matches must pass the rule's own proof where the
format has one (a CRC-32 in base 62, an IBAN's remainder, a card's Luhn digit, a token's header) or else look random enough.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "doc_id long, rule string, start long, length int, checked boolean, digest string"
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc62(secret: bytes) -> bool:
    """The last six characters are the CRC-32, in base 62, of what stands between the prefix and them."""
    body = secret.split(b"_", 1)[1]
    value = binascii.crc32(body[:-6])
    digits = b""
    for _ in range(6):
        value, k = divmod(value, 62)
        digits = _BASE62[k : k + 1] + digits
    return digits == body[-6:]


def luhn(secret: bytes) -> bool:
    digits = [c - 48 for c in secret if 48 <= c <= 57]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0 and len(set(digits)) > 1


def iban(secret: bytes) -> bool:
    plain = secret.replace(b" ", b"").decode().upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def header(secret: bytes) -> bool:
    """The first part of a web token is a JSON object that names an algorithm."""
    first = secret.split(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(first + b"=" * (-len(first) % 4)))
    except (ValueError, TypeError):
        return False


def random_enough(secret: bytes) -> bool:
    """At least 3 bits a character, as digests and keys have and words or repeated characters don't."""
    n = len(secret)
    return -sum(k / n * math.log2(k / n) for k in Counter(secret).values()) >= 3.0


@dataclass(frozen=True)
class Rule:
    """`pattern` begins with one of the keywords and is matched where that stands; its group 1, or the whole, is the secret."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern[bytes]
    proof: Callable[[bytes], bool] | None = None
    checksum: bool = False


def _p(source: str, flags: int = 0) -> re.Pattern[bytes]:
    return re.compile(source.encode(), flags)


_W = r"(?<![A-Za-z0-9_])"
_E = r"(?![A-Za-z0-9_])"
#: The length of an IBAN of each country.
_IBAN = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20,
    "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20, "YE": 30,
}
#: First digits of the cards of Visa, Mastercard, American Express, Diners, JCB, Discover, UnionPay, Maestro, RuPay, Mir and Verve.
_ISSUERS = ("4", "50", "51", "52", "53", "54", "55", "56", "57", "58", "60", "62", "63", "64", "65", "67", "68", "69", "81", "82", "34", "37", "30", "35", "36", "38", "39", *map(str, range(220, 273)))


def _bare_iban() -> re.Pattern[bytes]:
    """An IBAN of its country's length, in one piece or in groups of four."""
    by: dict[int, list[str]] = {}
    for country, n in _IBAN.items():
        by.setdefault(n - 4, []).append(country)
    tail = lambda n: f"(?:[A-Z0-9]{{{n}}}|(?: [A-Z0-9]{{4}}){{{n // 4}}}" + (f" [A-Z0-9]{{{n % 4}}})" if n % 4 else ")")
    return _p(_W + "(?:" + "|".join(f"(?:{'|'.join(own)})[0-9]{{2}}{tail(n)}" for n, own in by.items()) + ")" + _E)


def _bare_cards() -> list[Rule]:
    """A rule for each way to write a card, so that digits which follow a card in another group are left out by one of them."""
    shapes = ("[0-9]{13,19}", *(f"[0-9]{{4}}{s}[0-9]{{4}}{s}[0-9]{{4}}{s}[0-9]{{4}}{more}" for s in " -" for more in ("", f"{s}[0-9]{{1,3}}")), *(f"[0-9]{{4}}{s}[0-9]{{6}}{s}[0-9]{{4,5}}" for s in " -"))
    first = "(?<![0-9][.,])(?=" + "|".join(_ISSUERS) + ")"
    return [Rule("card_number", _ISSUERS, _p(_W + first + shape + _E), luhn, True) for shape in shapes]


RULES = (
    Rule("github_token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), _p(_W + r"gh[pousr]_[A-Za-z0-9]{36}" + _E), crc62, True),
    Rule("npm_token", ("npm_",), _p(_W + r"npm_[A-Za-z0-9]{36}" + _E), crc62, True),
    Rule("aws_access_key", ("akia", "asia"), _p(_W + r"(?:AKIA|ASIA)[A-Z2-7]{16}" + _E), random_enough),
    Rule("google_api_key", ("aiza",), _p(_W + r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])"), random_enough),
    Rule("slack_token", ("xoxb-", "xoxa-", "xoxp-", "xoxr-", "xoxs-"), _p(_W + r"xox[baprs]-[0-9A-Za-z-]{10,}"), random_enough),
    Rule("stripe_key", ("sk_live_", "rk_live_"), _p(_W + r"[sr]k_live_[0-9A-Za-z]{16,}" + _E), random_enough),
    Rule("private_key", ("-----begin",), _p(r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----")),
    Rule("web_token", ("eyj",), _p(_W + r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), header, True),
    Rule("bank_account", ("iban",), _p(r"IBAN\W{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)" + _E, re.I), iban, True),
    Rule("card_number", ("card",), _p(r"card(?: ?(?:number|no\.?))?\W{0,3}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])", re.I), luhn, True),
    Rule("bank_account", tuple(f"{c.lower()}{d}" for c in _IBAN for d in range(10)), _bare_iban(), iban, True),
    *_bare_cards(),
    Rule(
        "assigned_secret", ("token", "secret", "passwd", "password", "api_key", "apikey", "api-key", "access_key", "auth_key"),
        _p(r"""(?:token|secret|passwd|password|api[_-]?key|access_key|auth_key)["']?\s{0,4}[:=]\s{0,4}["']([A-Za-z0-9+/_=.-]{16,})["']""", re.I), random_enough,
    ),
)


def _automaton(rules: tuple[Rule, ...]) -> ahocorasick.Automaton:
    words: dict[str, list[Rule]] = {}
    for rule in rules:
        for word in rule.keywords:
            words.setdefault(word, []).append(rule)
    automaton = ahocorasick.Automaton()
    for word, own in words.items():
        automaton.add_word(word, (len(word), own))
    automaton.make_automaton()
    return automaton


def scan(raw: bytes, automaton: ahocorasick.Automaton) -> list[tuple[str, int, bytes, bool]]:
    """(rule, start, secret, whether a checksum proved it) of each secret, by place.  Of rules that find the same bytes the first counts."""
    found: dict[tuple[int, int], tuple[int, str, bool]] = {}
    for end, (size, rules) in automaton.iter(raw.lower().decode("latin-1")):
        for rule in rules:
            m = rule.pattern.match(raw, end + 1 - size)
            if m:
                k = 1 if rule.pattern.groups else 0
                secret = m[k]
                if rule.proof is None or rule.proof(secret):
                    mine = (RULES.index(rule) if rule in RULES else len(RULES), rule.name, rule.checksum)
                    where = m.span(k)
                    found[where] = min(found.get(where, mine), mine)
    return [(name, a, raw[a:b], checked) for (a, b), (_, name, checked) in sorted(found.items())]


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(RULES)
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist(), strict=True):
            for rule, start, secret, checked in scan(raw, automaton):
                for column, value in zip(out, (doc, rule, start, len(secret), checked, hashlib.sha256(secret).hexdigest()[:16]), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "rule", "start", "length", "checked", "digest"])


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, rule, start and length (in bytes of UTF-8), checked and digest of every secret in every row of `docs`.

    checked says that the secret passed a checksum of its own; one that fails its checksum is no secret.  The secret itself is not
    shown, only the beginning of its SHA-256.  A null or empty text has none; texts and secrets may have any length.  Where rules find the
    same bytes the first rule counts.  Rows that repeat, and null ids, are scanned each; other
    columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw")).where("raw is not null")
    return rows.mapInArrow(_scanner, RESULT)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`secrets` of all documents."""
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
