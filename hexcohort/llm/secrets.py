"""Secret scan with one combined automaton (see ``automaton``).

Each rule is a regex for the scanner plus, where the length of a part decides, an exact check of what was matched; a match
that fails its check is dropped but still uses up its text, as with a regex search followed by a test.

The span of a private key is its BEGIN marker, the long runs of base64 behind it (blanks or line ends between, also written as
``\\n``), and the END marker where it follows, after at most one short run.  ``redact`` also knows header fields, quotes and
comment marks between the lines, and goes on to the end of such keys.

Defined cases: a null text has no spans and stays null when redacted; an empty text has none; very long texts are read in
one linear pass; overlapping spans of different kinds are redacted as one; rows are independent of each other, repeated ones
too; new columns get underscores where a table has their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from hexcohort.llm.automaton import Scanner
from hexcohort.llm.common import append_columns, fresh, texts_of


def _assigned(match: bytes) -> bool:
    """The value behind the first : or = (and blanks, and a quote) has 12 characters or more."""
    mark = min(p for p in (match.find(b":"), match.find(b"=")) if p >= 0)
    value = match[mark + 1:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= 12


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    check: Callable[[bytes], bool] | None = None
    base: bool = False


# hex carries its least length in the pattern: its matches are whole runs of one class, so nothing else can be affected,
# and the scan then stops at long runs only
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, _assigned, True),
    Rule("access", r"AKIA[A-Z0-9]+", check=lambda m: len(m) >= 18, base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("private_key", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----(([\x20\x09\x0D\x0A]|\x5C[nr])*[A-Za-z0-9+/=]{16,})*"
                        r"((([\x20\x09\x0D\x0A]|\x5C[nr])+[A-Za-z0-9+/=]+)?([\x20\x09\x0D\x0A]|\x5C[nr])*-----END\x20([A-Z]+\x20)*PRIVATE\x20KEY-----)?"),
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]+", check=lambda m: len(m) >= 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", check=lambda m: len(m) >= 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

Span = tuple[int, int, int]    # start, place of the rule in RULES, end; in code points


@cache
def scanner() -> Scanner:
    """Compiled once per process."""
    return Scanner((r.pattern, r.ignore_case) for r in RULES)


def spans(text: str) -> list[Span]:
    """All spans, by start and then in the order of the rules."""
    data = text.encode()
    found, chars, at = [], 0, 0
    for rule, start, end in scanner().matches(data):
        check = RULES[rule].check
        if check is None or check(data[start:end]):
            chars += len(data[at:start].decode())
            at = start
            found.append((chars, rule, chars + end - start))     # matches are ASCII
    return found


# between the lines of a key: blanks, line ends (also written as \\n), quotes, marks of comments and of joined strings
_GAP = r"""(?:\\[nrt]|[\s"'`>#*|,;\\]|\+(?=\s))"""
_LONG = r"[A-Za-z0-9+/=]{16,}+"
_FIELD = r"(?:Proc-Type|DEK-Info|Content-Domain|Key-Info):[\x20\t]*[A-Za-z0-9-]+(?:,[A-Za-z0-9]+)*"
#: A key behind its marker: fields and runs of base64, the last run of any length.
_BODY = re.compile(rf"(?:{_GAP}*(?:{_FIELD}|{_LONG}))+(?:{_GAP}+[A-Za-z0-9+/=]++)?")
_MARKER = re.compile(r"-----(BEGIN|END)\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----")


def key_end(text: str, at: int) -> int:
    """Where the private key ends whose BEGIN marker ends at ``at``.

    Behind its END marker if what lies before that is mostly base64; without one (or with prose before it) behind the base64.
    """
    mark = _MARKER.search(text, at)
    if mark and mark[1] == "END":
        inside = text[at:mark.start()]
        if 2 * sum(map(len, re.findall(_LONG, inside))) >= sum(map(len, inside.split())):
            return mark.end()
    body = _BODY.match(text, at)
    return body.end() if body else at


def written(found: list[Span]) -> str:
    return ",".join(f"{RULES[r].kind}:{a}:{b}" for a, r, b in found)


def cleaned(text: str, mask: str) -> str:
    """The text with each span (overlapping ones as one, private keys with what follows their marker) replaced."""
    parts, at, ends = [], 0, -1
    for a, rule, b in spans(text):
        if a >= ends:
            parts += [text[at:a], mask]
        ends = max(ends, b, key_end(text, _MARKER.match(text, a).end()) if RULES[rule].kind == "private_key" else b)
        at = ends
    return "".join([*parts, text[at:]]) if parts else text


def _report(column: pa.Array) -> list[pa.Array]:
    rows = [spans(t) for t in texts_of(column)]
    base = [[s for s in found if RULES[s[1]].base] for found in rows]
    kinds = [i for i, r in enumerate(RULES) if r.base]
    return [*[pa.array([sum(s[1] == k for s in found) for found in base], pa.int64()) for k in kinds],
            pa.array([hashlib.sha256(written(found).encode()).hexdigest() for found in base], pa.string()),
            pa.array([written(found) for found in rows], pa.string())]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the base kinds, a digest of the base spans, and all spans."""
    found = fresh(docs, *[f"n_{r.kind}" for r in RULES if r.base], "base_sha256", "spans")
    fields = [StructField(n, LongType()) for n in found[:-2]] + [StructField(n, StringType()) for n in found[-2:]]
    return append_columns(docs, text, fields, _report)


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask``; ``n_chars``, if there, follows the new length."""
    def run(column: pa.Array) -> list[pa.Array]:
        return [pa.array([t if t is None else cleaned(t, mask) for t in column.to_pylist()], pa.string())]

    (new,) = fresh(docs, "redacted")
    out = append_columns(docs, text, [StructField(new, StringType())], run)
    columns = []
    for name, kind in docs.dtypes:
        if name == text:
            columns.append(f"`{new}` AS `{name}`")
        elif name == "n_chars":
            columns.append(f"CASE WHEN `{text}` = `{new}` OR `{text}` IS NULL THEN `n_chars` "
                           f"ELSE CAST(length(`{new}`) AS {kind}) END AS `n_chars`")
        else:
            columns.append(f"`{name}`")
    return out.selectExpr(*columns)
