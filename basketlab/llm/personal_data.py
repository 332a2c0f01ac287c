"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

A kind has a pattern, a check of the match, a score and context words. Kinds of the base
(email, ip, card, phone) are reported whenever their check holds. Further kinds start from a
lower score, rise with a checksum that holds or a context word within ``NEAR`` characters,
and are reported from ``THRESHOLD`` up.

Texts are scanned whole, by patterns that start at a place only where no earlier place of the
same run could have, so a long run of word characters or digits costs no more than its
length. Every text depends on itself alone: no shuffle.

Defined cases: a null or empty text has no spans. Repeated rows are scanned each. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEAR = 40
THRESHOLD = 0.5
BASE_KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: from each @ with a domain back over the characters before it."""
    end = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            end = found.end()
            yield start, end


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, nines cast out; the sum ends in 0."""
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def mod_97(account: str) -> bool:
    """An account number, first four characters moved to the end, letters as 10 to 35, leaves 1 by 97."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def _is_ip(value: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in value.split("."))


def _is_card(value: str) -> bool:
    digits = _digits(value)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_phone(value: str) -> bool:
    return 8 <= len(_digits(value)) <= 15


def _is_iban(value: str) -> bool:
    account = value.replace(" ", "")
    return 15 <= len(account) <= 34 and mod_97(account)


def _is_short_card(value: str) -> bool:
    digits = _digits(value)
    return 13 <= len(digits) <= 15 and luhn(digits)


def _is_social(value: str) -> bool:
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _always(value: str) -> bool:
    return True


@dataclass(frozen=True)
class Kind:
    """``score`` holds for a match, ``confirmed`` is added where ``check`` is a checksum, ``boost`` near a context word."""

    name: str
    pattern: re.Pattern
    check: Callable[[str], bool]
    score: float
    confirmed: float = 0.0
    context: tuple[str, ...] = ()
    boost: float = 0.3


FURTHER_KINDS = (
    Kind("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"), _is_iban, 0.3, 0.5,
         ("iban", "account", "konto", "cuenta", "compte", "bank")),
    Kind("short_card", re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,14}(?![0-9])"), _is_short_card, 0.1, 0.2,
         ("card", "credit", "visa", "amex", "karte", "tarjeta", "carte")),
    Kind("social_number", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _is_social, 0.3, 0.0,
         ("ssn", "social", "security", "tax")),
    Kind("local_phone", re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"), _always, 0.3, 0.0,
         ("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono", "téléphone")),
    Kind("secret", re.compile(r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,64}(?![A-Za-z0-9])"), _always, 0.3, 0.0,
         ("token", "secret", "key", "password", "passwd", "api")),
)


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the base kinds: leftmost, without overlaps within a kind, dropped where the check fails."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    for name, pattern, check in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
        for found in pattern.finditer(text):
            if check(found[0]):
                yield name, found.start(), found.end()


def further_spans(text: str, kinds: tuple[Kind, ...] = FURTHER_KINDS) -> Iterator[tuple[str, int, int]]:
    """Spans of the other kinds whose score, checksum and context together reach the threshold."""
    for kind in kinds:
        for found in kind.pattern.finditer(text):
            if not kind.check(found[0]):
                continue
            score = kind.score + kind.confirmed
            around = text[max(0, found.start() - NEAR):found.start()] + " " + text[found.end():found.end() + NEAR]
            if any(word in kind.context for word in re.findall(r"[^\W\d_]+", around.lower())):
                score += kind.boost
            if score >= THRESHOLD:
                yield kind.name, found.start(), found.end()


def _scan(batches):
    kinds = [*BASE_KINDS, *[k.name for k in FURTHER_KINDS]]
    for batch in batches:
        counts: list[list[int]] = [[] for _ in BASE_KINDS]
        digests, listed, further = [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = list(base_spans(text))
            more = list(further_spans(text))
            for i, name in enumerate(BASE_KINDS):
                counts[i].append(sum(s[0] == name for s in base))
            shown = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
            digests.append(hashlib.sha256(shown.encode()).hexdigest())
            listed.append(",".join(f"{k}:{a}:{b}" for k, a, b in sorted([*base, *more], key=lambda s: (kinds.index(s[0]), s[1]))))
            further.append(len(more))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
             pa.array(listed, pa.string()), pa.array(further, pa.int64())],
            names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_further"])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_further.

    ``spans`` lists kind:start:end in code points, end exclusive, by kind and then start.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {', '.join(f'n_{k} long' for k in BASE_KINDS)}, base_sha256 string, spans string, n_further long"
    return given.mapInArrow(_scan, schema)


def query(spark, folder: str) -> DataFrame:
    return find_personal_data(spark.read.parquet(f"{folder}/documents.parquet"))
