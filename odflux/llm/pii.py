"""Personal data by anchor expansion.

An automaton over all cues (at-signs, plus signs, digits, URL schemes and
identifier words) is run over a text once. At every cue a local parser expands
to both sides and validates what it finds, so text away from cues is never
looked at. Spans are in code points, the end exclusive.

Base kinds: email, ip, card, phone. Added kinds: url (with a scheme; user and
password in it are part of it), secret (the value after an identifier word
such as ``password=``), key (access keys with a fixed prefix) and account (an
international account number whose check digits hold, or a run of digits, after
an account word). Schemes and words are found in either case. Spans of different
kinds may overlap; those of one kind do not.

A missing or empty text has no spans. A text of any length is read whole; every
character is looked at a bounded number of times. Of cues that end together all
are tried, the longest first. Repeated rows are each done on their own, and a
missing id stays. Only doc_id and text (in masking, n_chars too) matter among
the columns. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.words import slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "secret", "key", "account")
# An address of a page is no personal data; an e-mail address or a secret in it is masked as such.
MASKED_KINDS = (*BASE_KINDS, "secret", "key", "account")

Span = tuple[int, int, int]  # start, number of the kind, end

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"[^\s<>\"'`{}|\\^]+")
VALUE = re.compile(r"\s{0,3}[=:]\s{0,3}[\"']?([^\s\"'<>]{6,})")
KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")

GAP = re.compile(r"[\s:#.=-]{0,4}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,17}(?![0-9])")

# Schemes, words before a secret and before an account, in lower case; fixed key prefixes of a public key format.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "git://", "ldap://", "jdbc:", "mongodb://", "postgres://", "redis://", "amqp://")
SECRET_WORDS = (
    "password", "passwd", "passphrase", "pwd", "passwort", "contraseña", "token", "secret", "credential", "credentials",
    "api_key", "apikey", "api-key", "access_key", "access-key", "accesskey", "private_key", "private-key", "auth_key", "signature",
)
ACCOUNT_WORDS = (
    "iban", "account number", "account no", "account", "acct", "routing number", "sort code", "kontonummer", "konto",
    "compte", "cuenta", "customer number", "customer no",
)
KEY_PREFIXES = ("akia", "asia")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[0::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


# A parser takes the text, the place of its cue, its end and the end of the last
# stretch its kind has used, and gives the stretch it uses now (None: none) and
# whether that is a span.
Parsed = tuple[int, int, bool] | None


def email(text: str, cue: int, _: int, used: int) -> Parsed:
    start = cue
    while start > used and text[start - 1] in LOCAL:
        start -= 1
    right = DOMAIN.match(text, cue + 1) if start < cue else None
    return (start, right.end(), True) if right else None


def ip(text: str, cue: int, _: int, used: int) -> Parsed:
    found = ADDRESS.match(text, cue)
    if not found:  # no later digit of this run begins an address either
        run = DIGITS.match(text, cue).end()
        return run, run, False
    parts = found[0].split(".")
    return cue, found.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def card(text: str, cue: int, _: int, used: int) -> Parsed:
    found = CARD.match(text, cue)
    if not found:
        return None
    digits = found[0].replace(" ", "").replace("-", "")
    return cue, found.end(), 12 <= len(digits) <= 19 and luhn(digits)


def phone(text: str, cue: int, _: int, used: int) -> Parsed:
    found = PHONE.match(text, cue)
    return (cue, found.end(), 9 <= sum(c in "0123456789" for c in found[0]) <= 15) if found else None


def url(text: str, cue: int, end: int, used: int) -> Parsed:
    rest = URL.match(text, end)
    if not rest:
        return None
    stop = end + len(rest[0].rstrip(".,;:!?)]"))
    return (cue, stop, True) if stop > end else None


def secret(text: str, cue: int, end: int, used: int) -> Parsed:
    found = VALUE.match(text, end)
    if not found:
        return None
    stop = found.start(1) + len(found[1].rstrip(".,;:!?)"))
    return (found.start(1), stop, True) if stop - found.start(1) >= 6 else None


def key(text: str, cue: int, end: int, used: int) -> Parsed:
    if cue and text[cue - 1].isalnum():
        return None
    found = KEY.match(text, end) if text[cue:end].isupper() else None
    return (cue, found.end(), True) if found else None


def account(text: str, cue: int, end: int, used: int) -> Parsed:
    """The longest stretch after the word whose check digits hold, else a run of 6 to 18 digits."""
    if cue and text[cue - 1].isalpha():
        return None
    at = GAP.match(text, end).end()
    if found := IBAN.match(text, at):
        stop = found.end()
        while stop - at >= 15:
            letters = text[at:stop].replace(" ", "")
            if text[stop - 1] != " " and len(letters) <= 34 and int("".join(str(int(c, 36)) for c in letters[4:] + letters[:4])) % 97 == 1:
                return at, stop, True
            stop -= 1
    found = ACCOUNT.match(text, at)
    return (at, found.end(), True) if found else None


Parser = Callable[[str, int, int, int], Parsed]
PARSERS: tuple[Parser, ...] = (email, ip, card, phone, url, secret, key, account)


@lru_cache(maxsize=1)
def cues() -> ahocorasick.Automaton:
    """All cues with their length and the kinds they are cues of."""
    kinds: dict[str, list[int]] = {"@": [0], "+": [3]}
    kinds |= {d: [1, 2] for d in "0123456789"}
    kinds |= {s: [4] for s in SCHEMES} | {w: [5] for w in SECRET_WORDS} | {p: [6] for p in KEY_PREFIXES} | {w: [7] for w in ACCOUNT_WORDS}
    automaton = ahocorasick.Automaton()
    for cue, found in kinds.items():
        automaton.add_word(cue, (len(cue), tuple(found)))
    automaton.make_automaton()
    return automaton


def lowered(text: str) -> str:
    """The text in lower case, letter by letter where lower case takes more letters."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def find(text: str) -> list[Span]:
    """All spans by start, then kind."""
    used = [0] * len(PARSERS)
    spans = []
    for last, (length, kinds) in cues().iter(lowered(text)):
        cue = last + 1 - length
        for kind in kinds:
            if cue < used[kind]:
                continue
            parsed = PARSERS[kind](text, cue, last + 1, used[kind])
            if parsed is None or parsed[0] < used[kind]:
                continue
            used[kind] = parsed[1]
            if parsed[2]:
                spans.append((parsed[0], kind, parsed[1]))
    spans.sort()
    return spans


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def mask(text: str, spans: list[Span], kinds: tuple[str, ...] = MASKED_KINDS) -> str:
    """The text with spans of ``kinds`` replaced by their kind in brackets; overlapping ones go as one, under the first's kind."""
    parts, at = [], 0
    for start, kind, end in spans:
        if KINDS[kind] not in kinds:
            continue
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, how many spans of each base kind, the base spans and all spans."""
    counts = [f"n_{kind}" for kind in BASE_KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [find(t) if t else [] for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s[1] < len(BASE_KINDS)] for spans in found]
            columns = [batch.column("doc_id")]
            columns += [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(len(BASE_KINDS))]
            columns += [pa.array(map(written, some), pa.string()) for some in (base, found)]
            yield pa.record_batch(columns, names=["doc_id", *counts, "base", "spans"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base string, spans string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def mask_texts(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; n_chars, where present, follows the new text, all else stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            new = [t if not t else mask(t, find(t)) for t in texts]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    masked = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return masked
    length = F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", length)
