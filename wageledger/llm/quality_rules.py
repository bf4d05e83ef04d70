"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one failure bit per rule, so that policies (versioned sets of rules) and
their ablations are bitwise operations on stored rows and never read a text
again.

Defined results: a null or empty text has no words and fails ``few_words``; a
null id or a repeated row is measured like any other row; other columns of the
input are not touched, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wageledger.llm.text import BLANKS, map_text, words

SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, "
    "n_upper long, n_letters long"
)


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurements; ``bit`` is its place for ever."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 20 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule(5, "capitals", "100 * n_upper > 50 * n_letters"),
    Rule(6, "no_letters", "10 * n_letters < 4 * word_chars"),
)


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules; a document passes if none of them fails."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[r] for r in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))


def measure(text: str | None) -> list[tuple]:
    """One row of measurements."""
    text = text or ""
    found = words(text)
    seen: set[str] = set()
    lines = again = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            again += line in seen
            seen.add(line)
    upper = sum(map(str.isupper, text))
    letters = sum(map(str.isalpha, text))
    return [
        (
            len(found),
            len(text) - sum(map(text.count, BLANKS)),
            sum(map(text.count, SYMBOLS)),
            lines,
            again,
            repeated_words(found),
            upper,
            letters,
        )
    ]


def repeated_words(found: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first time included."""
    windows = list(zip(found, found[1:], found[2:]))  # noqa: B905
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, total = 0, 0  # words before ``covered`` are counted
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``failures``, the bits of the rules that each document fails."""
    measured = map_text(docs, text, measure, MEASURES, [key])
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return measured.withColumn("failures", failures)


def passes(policy: Policy, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of ``policy``: documents that fail it, fail it alone, and pass without it.

    Documents collapse to their failure patterns first: at most two to the
    number of rules, whatever the size of the ledger.
    """
    pattern = F.col("failures").bitwiseAND(F.lit(policy.mask))
    patterns = rows.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"))
    rules = [(r.name, 1 << r.bit) for r in RULES if r.name in policy.rules]
    sums = []
    for name, bit in rules:
        held = F.col("pattern").bitwiseAND(F.lit(bit)) != 0
        rest = F.col("pattern").bitwiseAND(F.lit(policy.mask ^ bit)) == 0
        sums.append(
            F.struct(
                F.lit(policy.name).alias("policy"),
                F.lit(policy.version).alias("version"),
                F.lit(name).alias("rule"),
                F.coalesce(F.sum(F.when(held, F.col("n"))), F.lit(0)).alias("fails"),
                F.coalesce(F.sum(F.when(held & rest, F.col("n"))), F.lit(0)).alias("fails_alone"),
                F.coalesce(F.sum(F.when(rest, F.col("n"))), F.lit(0)).alias("passes_without"),
            )
        )
    return patterns.agg(F.array(*sums).alias("rules")).select(F.inline("rules"))
