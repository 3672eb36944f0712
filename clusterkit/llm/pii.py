"""Personal data by anchor expansion.

One Aho-Corasick pass over a text, A-Z lower-cased, finds anchors: at-signs, schemes, digits after a
dot or a plus, digits, colons of addresses, and words that announce an identifier. At each anchor a parser for one kind expands to
both sides, inside the bounds of what the kind can hold, and validates what it has. Nothing else of
the text is looked at, and all expansion is deterministic.

Four base kinds are found exactly as the leftmost non-overlapping matches of their patterns would
be, then validated; a match that fails is dropped and not tried again from within:

    email   local part @ labels joined by dots, two labels at least
    ip      four numbers joined by dots, each at most 255
    card    13 to 19 digits with single spaces or hyphens between, passing Luhn
    phone   plus, digits with spaces, brackets, dots and hyphens, 9 to 15 digits

Further kinds overlap them freely: email_intl (an address with letters beyond ASCII, whole),
email_spelled (name [at] host [dot] name), login (user:password in a URL), ipv6, iban, ssn,
account, secret.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from clusterkit.llm.common import BATCH_ROWS, id_and_text, map_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_intl", "email_spelled", "login", "ipv6", "iban", "ssn", "account", "secret")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
HEX = frozenset("0123456789abcdefABCDEF:.")

# What follows an anchor, tried at one place only.
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_four = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+").match
_chain = re.compile(r"[0-9](?:[\x20-]?[0-9])+").match
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").match
_wide_domain = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+").match
_spelled = re.compile(r" ?([A-Za-z0-9-]+(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]+)+)", re.I).match
_login = re.compile(r"([^\s/?#@:]+:[^\s/?#@]+)@").match
_suffix = r"(?:[_-](?:id|key|value|string|text|[0-9]{1,3})){0,2}"
_lead = re.compile(r"(?:[ _-]?(?:number|no\.?|id|key))?[ \t]{0,3}[=:#]?[ \t]{0,3}[\"']?", re.I).match
_assigned = re.compile(_suffix + r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?([A-Za-z0-9_./+=-]{16,})", re.I | re.A).match
_quoted = re.compile(_suffix + r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}([\"'])((?:(?!\1)[^\r\n]){4,128})\1", re.I | re.A).match
_password = re.compile(_suffix + r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?([^\s\"'<>,;]{4,})", re.I | re.A).match
_eight = re.compile(
    r"(?:[0-9A-F]{1,4}:){6}(?:[0-9A-F]{1,4}:[0-9A-F]{1,4}(?![0-9A-Z])|(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9A-Z]|\.[0-9]))(?!:[0-9A-F:])", re.I | re.A).match
_group_before = re.compile(r"(?:^|[^0-9A-Z])(?:[0-9A-F]{1,4})?:$", re.I).search
_iban = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}").match
_ssn = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])").match
_account = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])").match

# The words that announce an identifier, in lower case. A password is short and of any characters.
CUES = {
    "iban": ["iban"],
    "ssn": ["ssn", "social security"],
    "account": ["account", "acct", "konto", "compte", "cuenta"],
    "secret": ["token", "secret", "api_key", "apikey", "api-key", "api key", "access_key", "access-key", "access key",
               "private_key", "private-key", "secret_key", "secret-key", "secret key"],
    "password": ["password", "passwd", "passphrase", "pwd"],
}
#: Of anchors that are not named after what they find.
ANNOUNCED = {"password": "secret", "ipv6_full": "ipv6"}
_UPPER = {c: c + 32 for c in range(65, 91)}


@lru_cache(1)
def anchors():
    import ahocorasick

    words: dict[str, set[str]] = {"@": {"email"}, "://": {"login"}, "::": {"ipv6"}}
    for d in "0123456789":
        words[d] = {"card"}
        words["." + d] = {"ip"}
        words["+" + d] = {"phone"}
    for at in ("[at]", "(at)"):
        words[at] = {"email_spelled"}
    for a in "0123456789abcdef":
        for b in "0123456789abcdef":
            words[f"{a}:{b}"] = {"ipv6_full"}
    for kind, cues in CUES.items():
        for cue in cues:
            words.setdefault(cue, set()).add(kind)
    automaton = ahocorasick.Automaton()
    for word, kinds in words.items():
        for kind in kinds:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _left(text: str, at: int, floor: int, chars) -> int:
    while at > floor and text[at - 1] in chars:
        at -= 1
    return at


def _mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by kind as listed, then start."""
    found: list[tuple[str, int, int]] = []
    end = dict.fromkeys(KINDS, 0)  # where a kind's last match ended, valid or not

    def add(kind: str, a: int, b: int, good: bool = True) -> None:
        end[kind] = b
        if good:
            found.append((kind, a, b))

    # Lower-cased in ASCII alone, so that places are those of the text.
    for last, (cue, size) in anchors().iter(text.lower() if text.isascii() else text.translate(_UPPER)):
        at = last + 1 - size  # where the anchor starts
        kind = ANNOUNCED.get(cue, cue)
        if at < end[kind]:
            continue
        if kind == "card":
            if m := _chain(text, at):
                digits = m[0].replace(" ", "").replace("-", "")
                add(kind, at, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
        elif kind == "email":
            a = _left(text, at, end[kind], LOCAL)
            m = _domain(text, at + 1)
            if a < at and m:
                add(kind, a, m.end())
            _wide_email(text, at, end, add)
        elif kind == "ip":
            a = _left(text, at, end[kind], DIGITS)
            if a < at and (m := _four(text, a)):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                add(kind, a, m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts))
        elif kind == "phone":
            if m := _phone(text, at):
                add(kind, at, m.end(), 9 <= sum(c in DIGITS for c in m[0]) <= 15)
        elif kind == "login":
            if m := _login(text, last + 1):
                add(kind, m.start(1), m.end(1))
        elif cue == "ipv6_full":
            _ipv6_full(text, at, end, add)
        elif kind == "ipv6":
            _ipv6(text, at, end, add)
        elif kind == "email_spelled":
            b = at - 1 if at and text[at - 1] == " " else at
            a = _left(text, b, end[kind], LOCAL)
            if a < b and (m := _spelled(text, last + 1)):
                add(kind, a, m.end())
        elif cue == "password":
            if m := _quoted(text, last + 1):
                add(kind, m.start(2), m.end(2))
            elif m := _password(text, last + 1):
                add(kind, m.start(1), m.end(1))
        elif kind == "secret":
            if m := _assigned(text, last + 1):
                add(kind, m.start(1), m.end(1))
        else:
            _announced(text, kind, last + 1, add)
    found.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return found


def _wide_email(text: str, at: int, end: dict[str, int], add) -> None:
    """An address of which a letter beyond ASCII is part, so that the base kind cuts it short."""
    a = at
    while a > end["email_intl"] and (text[a - 1] in LOCAL or (text[a - 1] > "\x7f" and text[a - 1].isalpha())):
        a -= 1
    if a < at and (m := _wide_domain(text, at + 1)) and not text[a:m.end()].isascii():
        add("email_intl", a, m.end())


def _ipv6(text: str, at: int, end: dict[str, int], add) -> None:
    a = _left(text, at, max(end["ipv6"], at - 40), HEX)
    b = at
    while b < len(text) and b < at + 40 and text[b] in HEX:
        b += 1
    part = text[a:b].rstrip(".")
    if len(part) > 3:
        try:
            ipaddress.IPv6Address(part)
        except ValueError:
            return
        add("ipv6", a, a + len(part))


def _ipv6_full(text: str, at: int, end: dict[str, int], add) -> None:
    """An address without "::", which has its own anchor: whole groups, no more around them."""
    a = _left(text, at, max(end["ipv6"], at - 4), HEX - {":", "."})
    if (m := _eight(text, a)) and not (a and text[a - 1].isalnum()) and not _group_before(text[max(0, a - 6):a]):
        add("ipv6", a, m.end())


def _announced(text: str, kind: str, at: int, add) -> None:
    start = _lead(text, at).end()
    if kind == "iban":
        if m := _iban(text, start):
            # The country decides the length; what follows the number may be letters too.
            for cut in range(m.end(), start + 14, -1):
                code = text[start:cut].replace(" ", "")
                if text[cut - 1] != " " and 15 <= len(code) <= 34 and _mod97(code):
                    add(kind, start, cut)
                    return
    elif m := {"ssn": _ssn, "account": _account}[kind](text, start):
        add(kind, start, m.end())


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, spans (array of kind, start, end), one row for each row of ``docs``.

    Null and empty texts have none; null ids stay null; repeated rows are each searched; other
    columns are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def make():
        def work(batch: pa.RecordBatch) -> list:
            return [batch.column("doc_id"), [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(t)]
                for t in batch.column("text").to_pylist()]]

        return work

    return map_rows(id_and_text(docs, id_col, text_col), make,
                    "doc_id long, spans array<struct<kind:string,start:int,end:int>>",
                    pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))]))


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (as one string)."""
    def make():
        def work(batch: pa.RecordBatch) -> list:
            count, sha, spans = {k: [] for k in BASE}, [], []
            for text in batch.column("text").to_pylist():
                found = find(text)
                base = [s for s in found if s[0] in BASE]
                for kind in BASE:
                    count[kind].append(sum(s[0] == kind for s in base))
                sha.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
            return [batch.column("doc_id"), *count.values(), sha, spans]

        return work

    return map_rows(
        id_and_text(docs, id_col, text_col), make,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
        pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE],
                   ("base_sha256", pa.string()), ("spans", pa.string())]))


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one,
    named after the one that starts first, of those the longest."""
    out, at = [], 0
    spans = sorted(find(text), key=lambda s: (s[1], -s[2]))
    k = 0
    while k < len(spans):
        kind, a, b = spans[k]
        while k < len(spans) and spans[k][1] < b:
            b = max(b, spans[k][2])
            k += 1
        out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text column masked; all other columns as they are, whatever
    their names. Null texts stay null, empty ones empty, repeated rows are masked alike, and an empty
    table gives an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts = [t if t is None else masked(t) for t in batch.column(k).to_pylist()]
            columns = list(batch.columns)
            columns[k] = pa.array(texts, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.mapInArrow(run, docs.schema)
