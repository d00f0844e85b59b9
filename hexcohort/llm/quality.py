"""Quality rules as a bitmask ledger.

``ledger`` reads every whole text once and stores what was measured plus one bit per failed rule.  Everything later
(policies of any version, ablations, reports by group) works on those bits alone and never reads a text again.

Defined cases: a null or empty text has no words, all measures are 0 and it fails ``few_words``; repeated rows are judged
one by one; an empty table gives an empty ledger; other columns of any name pass through untouched.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from hexcohort.llm.common import append_columns, fresh, texts_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals")

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measures; all rules use whole numbers, so no rounding decides."""

    name: str
    failed: str


#: A rule's bit is its place here.  New rules go to the end: stored bits keep their meaning.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("many_capitals", "5 * n_capitals > 2 * n_letters"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A named choice of rules; a document goes if it fails any of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [r.name for r in RULES]
        return sum(1 << names.index(r) for r in set(self.rules))


BASE = Policy("base", ("few_words", "repeated_words"))
PRODUCTION = Policy("2", tuple(r.name for r in RULES))


def measure_text(text: str) -> tuple[int, ...]:
    """The numbers of ``MEASURES`` for one text."""
    data = text.encode()
    words = data.split()          # bytes split at space, \t, \n, \v, \f, \r and nothing else
    lines = [ln for ln in text.split("\n") if ln.strip(SPACES)]
    capitals = len(data) - len(data.translate(None, _UPPER))
    small = len(data) - len(data.translate(None, _LOWER))
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated_words(words), capitals + small, capitals)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a run of ``size`` words found at two or more places of the text."""
    runs = list(zip(*[words[i:] for i in range(size)], strict=False))
    found = Counter(runs)
    if len(found) == len(runs):
        return 0
    covered, end = 0, 0
    for i, run in enumerate(runs):
        if found[run] > 1:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def _measure(column: pa.Array) -> list[pa.Array]:
    rows = [measure_text(t) for t in texts_of(column)]
    return [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]


def ledger(docs: DataFrame, text: str = "text", bits: str = "failed") -> DataFrame:
    """``docs`` with one column per measure and ``bits``: bit i is set where rule i failed.

    The columns are added under free names (``fresh``) if ``docs`` has some of them already; ``names`` tells which.
    """
    columns = names(docs, bits)
    fields = [StructField(columns[m], LongType()) for m in MEASURES]
    measured = append_columns(docs, text, fields, _measure)
    return measured.withColumn(columns[bits], failed_bits(columns))


def names(docs: DataFrame, bits: str = "failed") -> dict[str, str]:
    """Measure (and ``bits``) to the column that ``ledger`` puts it in."""
    wanted = [*MEASURES, bits]
    return dict(zip(wanted, fresh(docs, *wanted), strict=True))


def failed_bits(columns: dict[str, str]) -> Column:
    """All rules over the measured columns, one bit each."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        failed = F.expr(" ".join(f"`{columns[w]}`" if w in columns else w for w in rule.failed.split()))
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def passes(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def keep(docs: DataFrame, policy: Policy = PRODUCTION, text: str = "text") -> DataFrame:
    """The documents that pass the policy, with the columns they came with."""
    bits = names(docs)["failed"]
    return ledger(docs, text).filter(passes(F.col(f"`{bits}`"), policy)).select(*[F.col(f"`{c}`") for c in docs.columns])


def ablation(book: DataFrame, policy: Policy = PRODUCTION, bits: str = "failed") -> DataFrame:
    """What each rule of the policy does: ``(rule, n_failed, n_alone, n_kept, n_kept_without)``.

    Rows fold to one per bit pattern first (at most 2 to the number of rules), whatever the size of the ledger.
    ``n_alone`` fail this rule and no other of the policy, which is what dropping the rule would give back.
    """
    patterns = book.groupBy(F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                      for i, r in enumerate(RULES) if r.name in policy.rules])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit, other = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.bitwise_not("bit"))

    def count(where: Column) -> Column:
        return F.sum(F.when(where, F.col("n")).otherwise(F.lit(0)))

    return each.groupBy("rule").agg(count(hit).alias("n_failed"), count(hit & (other == 0)).alias("n_alone"),
                                    count(F.col("bits") == 0).alias("n_kept"), count(other == 0).alias("n_kept_without"))


def judged(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """One row per document: id, measures, the bits, the base verdict and the policy's verdict."""
    book = ledger(docs.select("doc_id", "text")).drop("text")
    base_failed = ~passes(F.col("failed"), BASE)
    return (book.withColumn("base_failed", base_failed)
            .withColumn("kept", ~base_failed & passes(F.col("failed"), policy)))
