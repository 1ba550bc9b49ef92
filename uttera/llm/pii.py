"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, schemes, digits, plus signs and identifier cues. A deterministic
local parser expands each anchor to the boundaries of an email, address, number or account and validates it. Spans are
code points, end exclusive. Within a kind spans do not overlap; a failing candidate uses up its text. A run of digits
that fails as a whole is searched again for the cards and the phone number in it, which are kinds of their own: a card
may stand right beside another number.

Defined results. A null or empty text has no spans. Columns other than the text are not touched; the results replace
columns of their names. Rows are judged one by one, so repeated rows give repeated results.
"""

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.llm.common import LOWER, UPPER, over_texts, spare

#: Kinds in the order in which spans that start together are listed. The first four are the base kinds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "card_in_run", "phone_in_run", "obfuscated_email", "url_user", "iban", "national_id", "account", "secret")

# Cues before which or at which an identifier stands, by kind.
CUES = {
    "obfuscated_email": ("[at]", "(at)", "{at}"),
    "url_user": ("://",),
    "iban": ("iban",),
    "national_id": ("ssn", "social security", "passport", "national id"),
    "account": ("account", "acct", "routing", "konto", "cuenta", "compte"),
    "secret": ("password", "passwd", "api_key", "apikey", "api-key", "secret", "token", "AKIA"),
}

#: Characters of an IBAN, by country.
_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTHS = {country: length for length, countries in _COUNTRIES.items() for country in countries.split()}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CARD_FORM = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPELT = re.compile(r"\s?[A-Za-z0-9-]+(?:(?:\.|\s?[\[({]dot[\])}]\s?)[A-Za-z0-9-]+)+")
_USER = re.compile(r"://[^\s/@:]+:[^\s/@]+@")
_AFTER_CUE = re.compile(r"(?:\s?(?:no|nr|number|num|id)\b\.?)?\s?[:#=]?\s?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_NATIONAL = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])|[A-Z0-9]{8,9}(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){6,17}(?![0-9])")
_SECRET = re.compile(r"[\"']?\s?[:=]\s?[\"']?([A-Za-z0-9+/_.-]{8,})")
_ACCESS_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")

_ASCII_LOWER = str.maketrans(UPPER, LOWER)

Span = tuple[int, int, str]


def automaton() -> ahocorasick.Automaton:
    """Finds anchors in folded text."""
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for kind, cues in CUES.items():
        for cue in cues:
            found.add_word(cue.lower(), (kind, len(cue)))
    found.make_automaton()
    return found


_ANCHORS: list[ahocorasick.Automaton] = []


def _anchors() -> ahocorasick.Automaton:
    """Built once per Python worker; it is not sent along."""
    if not _ANCHORS:
        _ANCHORS.append(automaton())
    return _ANCHORS[0]


def folded(text: str) -> str:
    """Lower case, character by character: where lower() makes more of one, only ASCII is folded."""
    lower = text.lower()
    return lower if len(lower) == len(text) else text.translate(_ASCII_LOWER)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """The remainder by 97 of the rearranged number is 1."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def iban_at(text: str, at: int) -> re.Match | None:
    """The match cut at its country's length, else as far as capitals and digits go; the first that is valid, else the last tried."""
    whole = _IBAN.match(text, at)
    if whole and (length := IBAN_LENGTHS.get(whole[0][:2])):
        cut = re.compile(f"[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}").match(text, at)
        if cut and iban_valid(cut[0]):
            return cut
    return whole


def cards_in(text: str, start: int, end: int) -> Iterator[Span]:
    """Cards of a usual form inside a run that is none as a whole; after a wrong one the search goes on behind its first digit."""
    while m := _CARD_FORM.search(text, start, end):
        if luhn(re.sub("[ -]", "", m[0])):
            yield m.start(), m.end(), "card_in_run"
            start = m.end()
        else:
            start = m.start() + 1


def phone_in(text: str, start: int, end: int) -> Iterator[Span]:
    """The longest beginning of a run that is too long for a phone number, of whole groups of digits and 9 to 15 of these."""
    digits = last = 0
    for group in re.compile("[0-9]+").finditer(text, start, end):
        digits += group.end() - group.start()
        if digits > 15:
            break
        last = group.end() if digits >= 9 else 0
    if last:
        yield start, last, "phone_in_run"


def _local_start(text: str, at: int, least: int) -> int:
    """Where the run of characters of a mailbox name that ends before ``at`` begins, not before ``least``."""
    start = at
    while start > least and _LOCAL.match(text, start - 1, start):
        start -= 1
    return start


def spans(text: str | None) -> list[Span]:
    """All spans (start, end, kind), by start and then kind as listed in ``KINDS``."""
    if not text:
        return []
    used = dict.fromkeys(KINDS, 0)
    found: list[Span] = []

    def take(kind: str, match: re.Match | None, valid: bool = True, start: int | None = None) -> None:
        if match:
            used[kind] = match.end()
            if valid:
                found.append((match.start() if start is None else start, match.end(), kind))

    for last, (kind, length) in _anchors().iter(folded(text)):
        at = last + 1 - length
        if kind == "digit":
            if at >= used["card"] and (m := _CARD.match(text, at)):
                digits = re.sub("[ -]", "", m[0])
                valid = 12 <= len(digits) <= 19 and luhn(digits)
                take("card", m, valid)
                if not valid:
                    found.extend(cards_in(text, at, m.end()))
            if at >= used["ip"] and (at == used["ip"] or not "0" <= text[at - 1] <= "9") and (m := _IP.match(text, at)):
                take("ip", m, all(int(part) <= 255 for part in m.groups()))
            continue
        if at < used[kind]:
            continue
        if kind == "email":
            start = _local_start(text, at, used["email"])
            if start < at:
                take("email", _DOMAIN.match(text, at), start=start)
        elif kind == "phone":
            if m := _PHONE.match(text, at):
                digits = sum("0" <= c <= "9" for c in m[0])
                take("phone", m, 9 <= digits <= 15)
                if digits > 15:
                    found.extend(phone_in(text, at, m.end()))
        elif kind == "obfuscated_email":
            end = at - 1 if at > 0 and text[at - 1] == " " else at
            start = _local_start(text, end, used[kind])
            if start < end:
                take(kind, _SPELT.match(text, last + 1), start=start)
        elif kind == "url_user":
            take(kind, _USER.match(text, at))
        elif kind == "secret":
            if text.startswith("AKIA", at):
                take(kind, _ACCESS_KEY.match(text, at))
            elif m := _SECRET.match(text, last + 1):
                take(kind, m, any("0" <= c <= "9" for c in m[1]), start=m.start(1))
        else:
            after = _AFTER_CUE.match(text, last + 1).end()
            if kind == "iban":
                m = iban_at(text, after)
                take(kind, m, bool(m) and iban_valid(m[0]))
            elif kind == "national_id":
                m = _NATIONAL.match(text, after)
                take(kind, m, bool(m) and any("0" <= c <= "9" for c in m[0]))
            else:
                take(kind, _ACCOUNT.match(text, after))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(found: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def redacted(text: str, found: list[Span]) -> str:
    """Every span becomes its kind in angle brackets; overlapping spans become one, named after the first."""
    pieces, at = [], 0
    for start, end, kind in found:
        if start >= at:
            pieces += [text[at:start], f"<{kind.removesuffix('_in_run').upper()}>"]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def _decoded(texts: list[bytes | None]) -> Iterator[str]:
    return ("" if t is None else t.decode("utf-8", "replace") for t in texts)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds counts of the base kinds, the base spans' SHA-256 and all spans."""
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def batch(texts):
        for t in _decoded(texts):
            found = spans(t)
            base = [s for s in found if s[2] in BASE]
            counts = [sum(s[2] == kind for s in base) for kind in BASE]
            yield (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(found))

    held = spare(docs, "_pii")
    results = docs.withColumn(held, over_texts(docs.sparkSession, batch, schema)(F.col(text)))
    return results.withColumns({f.split()[0]: F.col(f"{held}.{f.split()[0]}") for f in schema.split(", ")}).drop(held)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The text without its spans; a null text stays null."""

    def batch(texts):
        return ((redacted(t, spans(t)),) for t in _decoded(texts))

    clean = over_texts(docs.sparkSession, batch, "clean string")(F.col(text))["clean"]
    # The call must not stand in a branch of its own: Python runs for every row, the branch is on its result.
    held = spare(docs, "_clean")
    return docs.withColumn(held, clean).withColumn(text, F.when(F.col(text).isNotNull(), F.col(held))).drop(held)
