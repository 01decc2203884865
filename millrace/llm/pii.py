"""Personal data and credentials: patterns propose spans, validators confirm them, nearby words adjust the score.

Validators are Luhn, mod-97, ranges of numbers and, for credentials, the entropy of their characters.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, struct

#: Kinds in the order in which equal starts are listed. The first four are the contract's base.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "key", "secret")
BASE_KINDS = 4

# Possessive repeats and the look-behinds keep every search linear in the text; each finds what
# the plain pattern finds, because a run that fails from its start fails from its inside too.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: Beginnings of well-known credentials, and the shape of each.
KEYS = {
    "AKIA": re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"),
    "ASIA": re.compile(r"(?<![A-Za-z0-9])ASIA[0-9A-Z]{16}(?![A-Za-z0-9])"),
    "ghp_": re.compile(r"(?<![A-Za-z0-9])ghp_[A-Za-z0-9]{36,64}(?![A-Za-z0-9])"),
    "glpat-": re.compile(r"(?<![A-Za-z0-9])glpat-[A-Za-z0-9_-]{20,64}(?![A-Za-z0-9])"),
    "xoxb-": re.compile(r"(?<![A-Za-z0-9])xoxb-[A-Za-z0-9-]{20,80}(?![A-Za-z0-9])"),
    "sk_live_": re.compile(r"(?<![A-Za-z0-9])sk_live_[A-Za-z0-9]{20,64}(?![A-Za-z0-9])"),
    "eyJ": re.compile(r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,2000}\.eyJ[A-Za-z0-9_-]{8,4000}\.[A-Za-z0-9_-]{8,1000}(?![A-Za-z0-9])"),
    "-----BEGIN": re.compile(r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]{0,8000}-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----)?"),
}
#: What follows the sign of an assignment, and the names before it that make it a secret.
ASSIGNED = re.compile(r"[:=][ \t]{0,3}[\"']?([A-Za-z0-9+/_.~$!@#%^&*-]{8,200})")
SECRET_NAMES = ("password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "api-key", "access_key", "access-key", "private_key", "auth_key")
#: Bits of entropy a character that a credential has at least.
ENTROPY = 2.5
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Words whose nearness supports a kind.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social security", "taxpayer"),
    "key": ("key", "token", "secret", "credential"),
    "secret": ("user", "login", "key", "config", "env", "account"),
}
#: Score of a span by its pattern alone, by a passed validator besides, and for context.
PLAIN, VALID, NEAR = 0.4, 0.3, 0.3


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    free = 0
    for m in DOMAIN.finditer(text):
        at = first = m.start()
        while first > free and text[first - 1] in LOCAL:
            first -= 1
        if first < at:
            free = m.end()
            yield first, free, False


def _ips(text: str):
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            yield *m.span(), True


def _cards(text: str):
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield *m.span(), True


def _phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield *m.span(), False


def _ibans(text: str):
    for m in IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield *m.span(), True


def _ssns(text: str):
    for m in SSN.finditer(text):
        yield *m.span(), False


def entropy(text: str) -> float:
    """Bits a character, by the text's own frequencies."""
    n = len(text)
    return sum(c / n * math.log2(n / c) for c in Counter(text).values())


def _keys(text: str):
    for begins, shape in KEYS.items():
        if begins in text:
            for m in shape.finditer(text):
                yield *m.span(), entropy(m[0]) >= ENTROPY


def _secrets(text: str):
    for m in ASSIGNED.finditer(text):
        named = text[max(0, m.start() - 24) : m.start()].rstrip(" \t\"'").lower()
        if named.endswith(SECRET_NAMES):
            yield *m.span(1), entropy(m[1]) >= ENTROPY and any(map(str.isdigit, m[1]))


FINDERS = (_emails, _ips, _cards, _phones, _ibans, _ssns, _keys, _secrets)


def find(text: str | None, window: int = 48) -> list[tuple[int, int, int, float, bool]]:
    """(kind's number, start, end, score, validated) by start, then kind.

    Base kinds are always listed. An added kind is listed from a score of 0.6 on: by its
    checksum, by its entropy if it is a credential, or by a context word within ``window`` code
    points.
    """
    out = []
    for k, finder in enumerate(FINDERS) if text else ():
        for start, end, valid in finder(text):
            around = text[max(0, start - window) : start].lower() + "\n" + text[end : end + window].lower()
            score = PLAIN + VALID * valid + NEAR * any(w in around for w in CONTEXT[KINDS[k]])
            if k < BASE_KINDS or score >= 0.6:
                out.append((k, start, end, round(score, 3), valid))
    return sorted(out, key=lambda x: (x[1], x[0]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 48) -> DataFrame:
    """One row per input row: id and ``spans``, an array of (kind, start, end, score, validated).

    Offsets are code points, ends exclusive. A null or empty text has an empty array; null ids
    and repeated rows pass through; other columns, whatever their names, are not read; an empty
    table gives none; whole texts of any length are searched in linear time. No shuffle.
    """
    schema = struct((id_col, docs.schema[id_col].dataType), ("spans", "array<struct<kind: string, start: bigint, end: bigint, score: double, validated: boolean>>"))

    def rows(batch: pa.RecordBatch) -> list:
        return [batch.column(0), [[{"kind": KINDS[k], "start": s, "end": e, "score": x, "validated": v} for k, s, e, x, v in find(t, window)] for t in batch.column(1).to_pylist()]]

    return arrow_map(docs.select(id_col, text_col), schema, rows)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from ``find_pii``'s rows."""
    schema = struct((id_col, found.schema[id_col].dataType), *((f"n_{k}", "bigint") for k in KINDS[:BASE_KINDS]), ("base_sha256", "string"), ("spans", "string"), ("n_spans", "bigint"))

    def rows(batch: pa.RecordBatch) -> list:
        counts, hashes, lists, totals = [[] for _ in KINDS[:BASE_KINDS]], [], [], []
        for spans in batch.column(1).to_pylist():
            said = [(x["kind"], f"{x['kind']}:{x['start']}:{x['end']}") for x in spans]
            for k, n in enumerate(counts):
                n.append(sum(kind == KINDS[k] for kind, _ in said))
            hashes.append(hashlib.sha256(",".join(s for kind, s in said if kind in KINDS[:BASE_KINDS]).encode()).hexdigest())
            lists.append(",".join(s for _, s in said))
            totals.append(len(said))
        return [batch.column(0), *counts, hashes, lists, totals]

    return arrow_map(found.select(id_col, "spans"), schema, rows)
