"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus-signs,
digits, schemes and identifier cues.  At each anchor a deterministic local
parser expands to the left and right, validates, and moves its kind's own
read position, so matches of a kind are leftmost and never overlap, and every
parser reads a character a bounded number of times: very long texts and very
long runs stay linear.

Kinds: ``email``, ``ip``, ``card`` (Luhn), ``phone`` are the base kinds.  The
anchors add ``url`` (an address with user information, scheme://user@host) and
``account`` (an IBAN with valid check digits, or a number of 6 to 18 digits
after an account cue).

Scale: one narrow pass, no shuffle, nothing shared; documents are judged alone.

Defined cases: a null or empty text has no spans; offsets are code points, end
exclusive; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import map_bodies

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
#: Words before an account number.
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "social security", "passport", "customer id", "konto", "cuenta", "compte")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(r"://[A-Za-z0-9._~%!$&*+,;=:-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:/[^\s\"'<>]*)?")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_AFTER_CUE = re.compile(r"[ ]?(?:no\.?|nr\.?|number|#)?[ ]?[:=]?[ ]?", re.I)
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,17}(?![0-9])")


def luhn(digits: str) -> bool:
    """Check digit of a card number."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


class Finder:
    """Spans (kind, start, end) of one text after another."""

    def __init__(self):
        import ahocorasick

        anchors = ahocorasick.Automaton()
        for c in "0123456789":
            anchors.add_word(c, (self._digit, 1))
        anchors.add_word("@", (self._at_sign, 1))
        anchors.add_word("+", (self._plus, 1))
        anchors.add_word("://", (self._scheme, 3))
        for cue in ACCOUNT_CUES:
            for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                anchors.add_word(form, (self._cue, len(form)))
        anchors.make_automaton()
        self.anchors = anchors

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        self.done = dict.fromkeys(KINDS, 0)
        self.chain = 0
        self.found: list[tuple[str, int, int]] = []
        for end, (parser, size) in self.anchors.iter(text):
            parser(text, end + 1 - size, end + 1)
        self.found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
        return self.found

    def _add(self, kind: str, start: int, end: int) -> None:
        self.found.append((kind, start, end))

    def _left(self, text: str, at: int, allowed: frozenset, least: int) -> int:
        while at > least and text[at - 1] in allowed:
            at -= 1
        return at

    def _at_sign(self, text: str, at: int, _: int) -> None:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = self._left(text, at, _LOCAL, self.done["email"])
            if start < at:
                self.done["email"] = domain.end()
                self._add("email", start, domain.end())

    def _digit(self, text: str, at: int, _: int) -> None:
        if at >= self.done["card"]:
            run = _CARD.match(text, at)
            self.done["card"] = run.end() if run else at + 1
            if run and run.end() - at >= 14:
                digits = run[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    self._add("card", at, run.end())
        if at >= self.chain:
            chain = _CHAIN.match(text, at)
            self.chain = chain.end()
            if chain.end() - at >= 7:
                parts = list(_PART.finditer(text, at, chain.end()))
                for k in range(0, len(parts) - 3, 4):
                    if all(_small(p[0]) for p in parts[k:k + 4]):
                        self._add("ip", parts[k].start(), parts[k + 3].end())

    def _plus(self, text: str, at: int, _: int) -> None:
        if at >= self.done["phone"] and (number := _PHONE.match(text, at)):
            self.done["phone"] = number.end()
            if 10 <= sum(map(number[0].count, "0123456789")) <= 15:
                self._add("phone", at, number.end())

    def _scheme(self, text: str, at: int, _: int) -> None:
        address = _USERINFO.match(text, at)
        if address:
            start = self._left(text, at, _SCHEME, self.done["url"])
            if start < at and text[start].isalpha():
                self.done["url"] = address.end()
                self._add("url", start, address.end())

    def _cue(self, text: str, at: int, end: int) -> None:
        if at and text[at - 1].isalnum() or at < self.done["account"]:
            return
        start = _AFTER_CUE.match(text, end).end()
        if start == end:
            return
        code = _IBAN.match(text, start)
        while code and not iban(code[0]):  # the code may run into the next words
            shorter = code[0][:-1].rstrip(" ")
            code = _IBAN.match(text, start, start + len(shorter)) if len(shorter) >= 15 else None
        code = code or _NUMBER.match(text, start)
        if code:
            self.done["account"] = code.end()
            self._add("account", start, code.end())


def _joined(spans: Iterator[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    def make():
        finder = Finder()

        def work(ids: list, texts: list) -> list:
            counts, digests, joined = [[] for _ in BASE_KINDS], [], []
            for text in texts:
                spans = finder.spans(text)
                for kind, column in zip(BASE_KINDS, counts, strict=True):
                    column.append(sum(s[0] == kind for s in spans))
                digests.append(hashlib.sha256(_joined(s for s in spans if s[0] in BASE_KINDS).encode()).hexdigest())
                joined.append(_joined(spans))
            return [ids, *counts, digests, joined]

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_bodies(_texts(docs, id_col, text_col), f"doc_id {kind}, " + "".join(f"n_{k} long, " for k in BASE_KINDS)
                      + "base_sha256 string, spans string", make)


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with each span replaced by its kind in angle brackets;
    overlapping spans by that of the first."""
    def make():
        finder = Finder()

        def work(ids: list, texts: list) -> list:
            out = []
            for text in texts:
                parts, done = [], 0
                for kind, start, end in finder.spans(text):
                    if start >= done:
                        parts += [text[done:start], f"<{kind}>"]
                    done = max(done, end)
                out.append("".join([*parts, text[done:]]))
            return [ids, out]

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_bodies(_texts(docs, id_col, text_col), f"doc_id {kind}, text string", make)
