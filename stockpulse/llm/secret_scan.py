"""Secret scans: base patterns plus assignment-aware lexing.

The lexer reads a whole text once for ``name = value`` and ``name: value`` forms
of source and configuration syntax (dotted, bracketed and quoted names, quoted
or bare values of any length, joined string pieces, defaults of environment
variables in calls and choices, declarations with a type; any blanks around signs;
triple-quoted strings and indented blocks behind ``|`` or ``>``), and for elements
``<name>value</name>`` and pairs ``key="name" value="value"`` of markup.  Names have any length.  Values that are
names of earlier literals are resolved (constant propagation, in order of
appearance, through chains), and each literal is scored by the most sensitive
name it reaches, its length, its mix of characters and its entropy; placeholders
score nothing, and neither do blocks that are mostly words.  Literals at or above ``threshold`` add spans of kind ``lexed``
at the literal itself, unless a base span already covers it.

Spans are code points, end exclusive.  Defined cases: null text is empty and has
no spans; rows are judged one by one, so ties and repeats do not matter; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")  # the runs [0-9a-f]+ of 32 or more, without the rest
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "lexed")
# Parts of names and how sensitive they are.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.7, "bearer": 0.8, "private": 0.6, "signing": 0.6,
    "encryption": 0.6, "access": 0.5, "key": 0.5, "salt": 0.5, "cert": 0.4, "session": 0.4}
PLACEHOLDER = re.compile(
    r"(?:x{3,}|\*{3,}|\.{3,}|<.*>|\$\{.*\}|%.*%|your[_-].*|example.*|changeme|placeholder|todo|none|null|true|false"
    r"|undefined|test(?:ing)?|dummy|redacted)", re.IGNORECASE | re.ASCII)
_STRING = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`)"""
_BINDS = re.compile(r"(?<![=!<>:+*/-])(?::=|=>|[:=])(?![=:])[\x20\t]*")
_IN_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_NAME_START = re.compile(r"[A-Za-z_]")
_STRINGS = rf"{_STRING}(?:[\x20\t]*[+.][\x20\t]*{_STRING})*"
_QUOTED, _BARE = re.compile(_STRINGS), re.compile(r"[A-Za-z0-9+/_.=~@!-]+")
# What stands before a literal that is the default of an environment variable: a call or a choice.
_ENV_CALL = re.compile(
    rf"(?:[A-Za-z_][A-Za-z0-9_]*(?:\.|::))*(?:getenv|environ\.get|environ\.setdefault|env(?:\.(?:get|str))?|ENV\.fetch)"
    rf"\([\x20\t\n]*{_STRING}[\x20\t\n]*,[\x20\t\n]*(?:default[\x20\t]*=[\x20\t]*)?")
_ENV_ELSE = re.compile(
    rf"(?:process\.env(?:\.[A-Za-z0-9_]+|\[{_STRING}\])|os\.environ\[{_STRING}\]|ENV\[{_STRING}\]"
    rf"|(?:[A-Za-z_][A-Za-z0-9_]*\.)*(?:getenv|environ\.get)\([\x20\t]*{_STRING}[\x20\t]*\))"
    r"[\x20\t]*(?:\|\||\?\?|\?:|or\b)[\x20\t]*")
# The type and sign that stand between a declared name's colon and its value.
_TYPE = r"""(?:&(?:'[a-z]+[\x20\t]+)?)?[A-Za-z_][A-Za-z0-9_.]*(?:\[[A-Za-z0-9_.,|\x20"']*\]|<[A-Za-z0-9_.,|\x20]*>)?"""
_TYPED = re.compile(rf"{_TYPE}(?:[\x20\t]*\|[\x20\t]*{_TYPE})*\??[\x20\t]*=(?![=>])[\x20\t]*")
_PIECE = re.compile(_STRING)
# An indented block's head, an element with text only, and a pair of attributes.
_BLOCK = re.compile(r"[|>][+-]?[1-9]?[+-]?[\x20\t]*(?:#[^\n]*)?\n")
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.:-]*)(?:\s[^<>]*)?>([^<>]+)</")
_ATTRIBUTES = re.compile(
    r"""\b(?:key|name)[\x20\t]*=[\x20\t]*["']([A-Za-z0-9_.:-]+)["']\s+value[\x20\t]*=[\x20\t]*(?:"([^"<>\n]+)"|'([^'<>\n]+)')""",
    re.IGNORECASE | re.ASCII)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def sensitivity(name: str) -> float:
    """The weight of the most sensitive part of a name, with pairs of parts such
    as access key or private key counting more."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    weights = [SENSITIVE.get(p, 0.0) for p in parts]
    for a, b in zip(parts, parts[1:]):
        weights.append(SENSITIVE.get(a + b, 0.0))
        if b == "key" and a in ("api", "access", "private", "secret", "signing", "encryption", "auth"):
            weights.append(1.0)
    return max(weights, default=0.0)


def entropy(literal: str) -> float:
    n = len(literal)
    return -sum(k / n * math.log2(k / n) for k in Counter(literal).values()) if n else 0.0


def literal_score(literal: str, name_weight: float) -> float:
    """0..1: how much a literal under such a name looks like a secret."""
    if len(literal) < 8 or PLACEHOLDER.fullmatch(literal) or not name_weight:
        return 0.0
    mixed = sum(bool(re.search(k, literal)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    spread = min(1.0, entropy(literal) / 3.0)
    words_only = re.fullmatch(r"[A-Za-z]+|[a-z]+(?:[ _.-][a-z]+)+", literal, re.ASCII) is not None
    return name_weight * spread * (0.4 if words_only else 0.7 + 0.1 * mixed)


def name_before(text: str, stop: int) -> str | None:
    """The name that ends at ``stop``: of a subscript if there is one, else what stands before."""
    def back(end: int) -> int:
        while end and text[end - 1] in _IN_NAME:
            end -= 1
        return end

    if stop and text[stop - 1] in "\"'":
        stop -= 1
    key = None
    if stop > 1 and text[stop - 1] == "]" and text[stop - 2] in "\"'":
        low = back(stop - 2)
        if low == stop - 2 or low < 2 or text[low - 1] not in "\"'" or text[low - 2] != "[":
            return None
        key, stop = text[low:stop - 2], low - 2
    start = _NAME_START.search(text, back(stop), stop)
    return (key or text[start.start():stop]) if start else None


def _stripped(text: str, start: int, stop: int) -> tuple[int, int]:
    """The span without blanks at its ends."""
    inner = text[start:stop]
    start += len(inner) - len(inner.lstrip())
    return start, start + len(inner.strip())


def block_after(text: str, head: re.Match, stop: int) -> tuple[int, int] | None:
    """The block of lines that stand deeper than the line of the name before ``stop``."""
    line = text.rfind("\n", 0, stop) + 1
    depth = len(text[line:stop]) - len(text[line:stop].lstrip(" \t"))
    first, last, at = -1, -1, head.end()
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        own = text[at:end]
        if own.strip():
            deep = len(own) - len(own.lstrip(" \t"))
            if deep <= depth:
                break
            first, last = (first if first >= 0 else at + deep), at + len(own.rstrip())
        at = end + 1
    return (first, last) if first >= 0 else None


def block_score(literal: str) -> float:
    """``literal_score`` of a literal of several lines or of markup, for a name of weight 1;
    text that is mostly words is none."""
    pieces = literal.split()
    words = sum(p.strip(".,;:!?()\"'").isalpha() for p in pieces)
    return 0.0 if len(pieces) > 3 and 2 * words > len(pieces) else literal_score(literal, 1.0)


class _Run:
    """A run of bare characters and the shares of a full score that its tails
    behind each ``=`` have, all counted in one pass from its end."""

    def __init__(self, text: str, start: int, stop: int):
        self.start, self.stop = start, stop
        self.end = start + len(text[start:stop].rstrip("."))
        self.text, self.shares = text, None

    def share(self, at: int) -> float:
        """``literal_score`` of the run from ``at`` on, for a name of weight 1."""
        if self.shares is None:
            if at == self.start or self.text.find("=", at, self.end) < 0:
                return literal_score(self.text[at:self.end], 1.0)
            self.shares = self._tails()
        return self.shares[at] if at in self.shares else literal_score(self.text[at:self.end], 1.0)

    def _tails(self) -> dict[int, float]:
        counts: Counter = Counter()
        shares, stop = {}, self.end
        while (sign := self.text.rfind("=", self.start, stop)) >= 0:
            counts.update(self.text[sign + 1:stop])
            at, n = sign + 1, self.end - sign - 1
            if stop == self.end:
                shares[at] = literal_score(self.text[at:stop], 1.0)
            elif n < 8 or _PLACE_START.match(self.text, at):
                shares[at] = 0.0
            else:  # with a sign in it the tail is neither words alone nor another placeholder
                seen = "".join(counts)
                mixed = sum(bool(re.search(k, seen)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
                spread = -sum(k / n * math.log2(k / n) for k in counts.values()) / 3.0
                shares[at] = min(1.0, spread) * (0.7 + 0.1 * mixed)
            counts["="] += 1
            stop = sign
        return shares


_PLACE_START = re.compile(r"your[_-]|example", re.IGNORECASE | re.ASCII)


def lexed_spans(text: str, threshold: float) -> list[tuple[int, int]]:
    """Spans of literals that sensitive names are bound to, directly or through constants."""
    found: dict[tuple[int, int], float] = {}
    constants: dict[str, tuple[list[tuple[int, int]], float]] = {}
    run, typed, longest = None, -1, 0
    unclosed = {}  # where the search for the end of a triple-quoted string found none

    def note(name: str, share: float, spans: list[tuple[int, int]]) -> None:
        score = sensitivity(name) * share
        if score and score >= threshold:
            for a, b in spans:
                if b > a:
                    found[a, b] = max(score, found.get((a, b), 0.0))

    def block(start: int, stop: int) -> tuple[int, int] | None:
        triple = text[start:start + 3]
        if triple in ('"""', "'''") and triple not in unclosed:
            close = text.find(triple, start + 3)
            if close >= 0:
                return _stripped(text, start + 3, close)
            unclosed[triple] = start
        head = _BLOCK.match(text, start)
        return block_after(text, head, stop) if head else None

    for e in _ELEMENT.finditer(text):
        if text.startswith(e[1], e.end()) and text[e.end() + len(e[1]):e.end() + len(e[1]) + 1] in (">", " ", "\n"):
            span = _stripped(text, *e.span(2))
            note(e[1], block_score(text[span[0]:span[1]]), [span])
    for e in _ATTRIBUTES.finditer(text):
        span = e.span(2) if e[2] else e.span(3)
        note(e[1], block_score(text[span[0]:span[1]]), [span])
    for bind in _BINDS.finditer(text):
        stop, start = bind.start(), bind.end()
        if stop < typed:  # the sign behind a declared type, whose value is read already
            continue
        while stop and text[stop - 1] in " \t":
            stop -= 1
        name = name_before(text, stop)
        if not name:
            continue
        if text[bind.start()] == ":" and (kind := _TYPED.match(text, start)):
            start = typed = kind.end()
        inner = block(start, stop)
        quoted = _QUOTED.match(text, start) if not inner else None
        if not inner and not quoted and (before := _ENV_CALL.match(text, start) or _ENV_ELSE.match(text, start)):
            quoted = _QUOTED.match(text, before.end())
        if inner:
            literals, share = [inner], block_score(text[inner[0]:inner[1]])
        elif quoted:
            literals = [(p.start() + 1, p.end() - 1) for p in _PIECE.finditer(text, quoted.start(), quoted.end())]
            share = literal_score("".join(text[a:b] for a, b in literals), 1.0)
        else:
            if run is None or not run.start <= start < run.stop:  # a run is read once, however many signs it has
                bare = _BARE.match(text, start)
                if not bare:
                    continue
                run = _Run(text, *bare.span())
            end = max(run.end, start)
            # no name is longer than ``longest``
            known = constants.get(text[start:end]) if end - start <= longest else None
            if not known and (dot := text.rfind(".", max(start, end - longest - 1), end)) >= 0:
                known = constants.get(text[dot + 1:end])
            literals, share = known or ([(start, end)], run.share(start) if end > start else 0.0)
        constants[name] = constants[name.rpartition(".")[2]] = literals, share
        longest = max(longest, len(name))
        note(name, share, literals)
    return sorted(found)


def scan(text: str | None, threshold: float) -> tuple[int, int, int, str, str]:
    """n_assign, n_access, n_hex, base spans, all spans."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        least = LEAST[KINDS[kind]]
        base += [(a, kind, b) for a, b in (m.span() for m in pattern.finditer(text)) if b - a >= least]
    base.sort()
    counts = Counter(k for _, k, _ in base)
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))

    def covered(a: int, b: int) -> bool:  # by a base span: of those that start before, one ends behind
        before = bisect_right(starts, a)
        return before > 0 and reach[before - 1] >= b

    lexed = lexed_spans(text, threshold) if "=" in text or ":" in text or "</" in text else []
    more = [(a, 3, b) for a, b in lexed if not covered(a, b)]
    show = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return counts[0], counts[1], counts[2], show(base), show(sorted(base + more))


def scan_secrets(docs: DataFrame, threshold: float = 0.45, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans) per document."""
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_spans string, spans string")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(t, threshold) for t in texts],
                            columns=["n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), scanned(F.col(text_col)).alias("s")).select("doc_id", "s.*")


def base_digest(spans: str) -> str:
    """SHA-256 of joined spans; the query computes the same with Spark's ``sha2``."""
    return hashlib.sha256(spans.encode()).hexdigest()
