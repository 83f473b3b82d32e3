"""Personal data with offset-preserving deobfuscation (operator 7).

Base detectors look for emails, IPv4 addresses, payment cards (Luhn) and international phone numbers
in the text as it stands.  Two transducers then rewrite disguises, keeping for every output character
the source characters it came from:

* characters: full-width forms, other scripts' digits, mathematical letters and look-alike Greek and
  Cyrillic letters become ASCII, invisible characters go;
* tokens: ``(at)``, ``[dot]``, ``at ... dot`` and spaced ``@`` in an address become ``@`` and ``.``;
  runs of spelled digits (English, French, German, Spanish), with ``plus`` and ``dot``, become digits.

The same detectors run on the rewritten text, and their spans go back to source characters.  A span
that rewriting made possible is added unless a base span of its kind holds it whole; base spans stay,
also those that are a fragment of an added one.

``n_*`` count base spans.  Defined cases: a null text is empty and has no spans; offsets are code
points, the end exclusive; empty and very long texts are read whole (each detector is linear in the
text).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from rillet.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]          # start, kind, end

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for run in _DOTTED.finditer(text):
        part = run.group()
        if part.count(".") >= 3:
            for m in _IP.finditer(part):
                if all(len(x) <= 3 and int(x or 0) <= 255 for x in (y.lstrip("0") for y in m.group().split("."))):
                    yield run.start() + m.start(), run.start() + m.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """Spans of the base detectors, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        out += [(s, 1, e) for s, e in _ips(text)]
        out += [(s, 2, e) for s, e in _cards(text)]
        out += [(s, 3, e) for s, e in _phones(text)]
    return sorted(out)


# -- transducers --------------------------------------------------------------------

# Letters of other scripts that look like ASCII letters.
_LOOKALIKES = dict(zip("аеорсухіѕјԁһӏАВЕКМНОРСТУХІЅЈοαενικρυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aeopcyxisjdhlABEKMHOPCTYXISJoaevikpuxABEZHIKMNOPTYX"))
_INVISIBLE = "­​‌‍⁠﻿"
_FOREIGN = re.compile("[­²³¹Ͱ-ϿЀ-ԯ٠-٩۰-۹०-९"
                      "​-‍⁠⁰-ₙ①-⒛⓪﹒﹫﻿！-～"
                      "\U0001d400-\U0001d7ff]")
# The digits as words.
_SPELLED = {w: str(i) for names in (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve") for i, w in enumerate(names.split())}
_WORD = "|".join(sorted(_SPELLED, key=len, reverse=True))
_AT = r"(?:\s{0,2}[\[({<]\s{0,2}(?:at|@)\s{0,2}[\])}>]\s{0,2}|\s{1,2}at\s{1,2}|\s{0,2}@\s{0,2})"
_DOT = r"(?:\s{0,2}[\[({<]\s{0,2}(?:dot|\.)\s{0,2}[\])}>]\s{0,2}|\s{1,2}dot\s{1,2})"
_HINT = re.compile(r"[\[({<]\s{0,2}(?:at|@|dot|\.)\s{0,2}[\])}>]|\bdot\b|\s@|@\s", re.I)
_NAME = "[A-Za-z0-9_%+-]"
_ADDRESS = re.compile(rf"(?<!{_NAME}){_NAME}++(?:(?:\.|{_DOT}){_NAME}++){{0,7}}?(?P<at>{_AT})[A-Za-z0-9-]++"
                      rf"(?:(?:{_DOT}|\.)[A-Za-z0-9-]++){{1,9}}", re.I)
_PART = re.compile(rf"(?P<at>{_AT})|(?P<dot>{_DOT})", re.I)
_RUN = re.compile(rf"(?:(?<!\w)plus\s{{1,2}}|\+\s{{0,2}})?(?<!\w)(?:(?:{_WORD}|[0-9]{{1,4}})(?!\w)"
                  rf"(?:[ ,-]{{1,2}}(?:dot|point|punto|punkt)[ ,-]{{1,2}}|[ ,.-]{{1,2}}|$|(?=\W))){{4,}}", re.I)
_RUN_HINT = re.compile(rf"(?<!\w)(?:{_WORD})(?:[ ,.-]{{1,2}}|[ ]dot[ ])(?:{_WORD}|[0-9])(?!\w)", re.I)
_RUN_PART = re.compile(rf"(?P<word>{_WORD})(?!\w)|(?P<plus>plus\s{{1,2}}|\+\s{{0,2}})|(?P<digit>[0-9])"
                       rf"|(?P<dot>[ ,-]{{0,2}}(?:dot|point|punto|punkt)[ ,-]{{0,2}}|\.(?=[0-9]))|(?P<gap>[ ,.-]+)", re.I)


class Rewritten:
    """A text under rewriting: its characters and, for each, the source characters it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = range(len(text))
        self.end = range(1, len(text) + 1)
        self.changed: list[tuple[int, int]] = []        # source spans that were rewritten

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply ascending, disjoint edits (start, end, new text) on the present text."""
        if not edits:
            return
        parts, start, end, done = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[done:a], new]
            start += self.start[done:a]
            end += self.end[done:a]
            source = (self.start[a], self.end[b - 1])
            start += [source[0]] * len(new)
            end += [source[1]] * len(new)
            self.changed.append(source)
            done = b
        parts.append(self.text[done:])
        start += self.start[done:]
        end += self.end[done:]
        self.text, self.start, self.end = "".join(parts), start, end


def fold_character(c: str) -> str:
    """The ASCII character that ``c`` passes for; empty for an invisible one, ``c`` itself otherwise."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain < "\x7f" else c


def _character_edits(text: str):
    for m in _FOREIGN.finditer(text):
        new = fold_character(m.group())
        if new != m.group():
            yield m.start(), m.end(), new


def _address_edits(text: str):
    for m in _ADDRESS.finditer(text):
        body = m.group()
        parts = [p for p in _PART.finditer(body)]
        bare = m.group("at").strip().lower() == "at"
        if bare and not any(p.lastgroup == "dot" and p.start() > m.start("at") - m.start() for p in parts):
            continue                                      # "look at example.com" is no address
        for p in parts:
            new = "@" if p.lastgroup == "at" else "."
            if p.group() != new:
                yield m.start() + p.start(), m.start() + p.end(), new


def _digit_edits(text: str):
    for m in _RUN.finditer(text):
        body = m.group().rstrip(" ,.-")
        parts = list(_RUN_PART.finditer(body))
        if not any(p.lastgroup == "word" for p in parts):
            continue
        for p in parts:
            new = {"word": _SPELLED.get(p.group().lower(), ""), "plus": "+", "digit": p.group(),
                   "dot": ".", "gap": ""}[p.lastgroup]
            if p.group() != new:
                yield m.start() + p.start(), m.start() + p.end(), new


def rewrite(text: str) -> Rewritten | None:
    """``text`` with disguises undone, or None where there are none."""
    out = Rewritten(text)
    if _FOREIGN.search(text):
        out.replace(list(_character_edits(text)))
    if _HINT.search(out.text):
        out.replace(list(_address_edits(out.text)))
    if _RUN_HINT.search(out.text):
        out.replace(list(_digit_edits(out.text)))
    return out if out.changed else None


def all_spans(text: str, base: list[Span] | None = None) -> list[Span]:
    """Base spans and those that rewriting adds, by start, then kind."""
    base = base_spans(text) if base is None else base
    new = rewrite(text)
    if new is None:
        return base
    out = list(base)
    for start, kind, end in base_spans(new.text):
        a, b = new.start[start], new.end[end - 1]
        if any(s < b and a < e for s, e in new.changed) and \
                not any(k == kind and s <= a and b <= e for s, k, e in base):
            out.append((a, kind, b))
    return sorted(out)


# -- frames ---------------------------------------------------------------------------

def spell(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _detect(batches):
    for batch in batches:
        counts, digests, found = [[] for _ in KINDS], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            for k, c in enumerate(counts):
                c.append(sum(1 for s in base if s[1] == k))
            digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
            found.append(spell(all_spans(text or "", base)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
             pa.array(digests, pa.string()), pa.array(found, pa.string())],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every row of ``docs`` (doc_id, text)."""
    return map_texts(
        docs.select("doc_id", "text"), _detect, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_text(text: str) -> str:
    """``text`` with spans replaced by their kind, like ``<email>``: overlapping ones whole, by the first."""
    out, done = [], 0
    for s, k, e in all_spans(text):
        if s >= done:
            out += [text[done:s], f"<{KINDS[k]}>"]
        done = max(done, e)
    out.append(text[done:])
    return "".join(out)


def _redact(batches):
    for batch in batches:
        texts = [None if t is None else redact_text(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def redact(docs: DataFrame) -> DataFrame:
    """``row, text`` with personal data replaced; ``docs`` holds ``row, text`` (see ``common.held``)."""
    docs = docs.select("row", "text")
    return map_texts(docs, _redact, docs.schema)
