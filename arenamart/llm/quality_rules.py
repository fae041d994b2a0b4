"""Quality rules as a learned decision list, all in Spark expressions.

``with_statistics`` adds the base statistics of a text; ``learn`` grows and prunes an ordered list of
threshold conjunctions by sequential covering; ``verdict`` is the list as one conditional expression.

Words are runs without ASCII white space. Lines are split at line feeds; a duplicate line has a word
and equals an earlier line of its text. A repeated word lies in a window of three words that stands
twice or more in the text, the first place included.

Defined results: a null or empty text has no words and fails the base; every row is judged by itself,
so repeated rows get equal results; without labelled rows the list is empty and keeps what passes the
base; extra columns are kept by ``with_statistics``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart.llm.common import WORD, read, split_words, trainable

SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS = 50
#: Labelled rows that the list is learned from: those with the smallest hash of their id.
FIT_ROWS = 4_000
CUTS = 24
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")
LOW_31 = (1 << 31) - 1


def with_statistics(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and n_upper, n_lines.

    Columns that had these names before are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    kept = [c for c in docs.columns if c not in STATISTICS]
    step = docs.select(
        *kept,
        split_words(F.col("text")).alias("_words"),
        lines.alias("_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("bigint").alias("n_upper"),
    )
    words = F.col("_words")
    triples = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    none = F.array().cast("array<bigint>")
    step = step.select(
        *kept,
        "_words",
        "n_symbols",
        "n_upper",
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(words) >= 3, triples).otherwise(none).alias("_triples"),
    )
    found = [c for c in step.columns if c not in ("_words", "_triples")]
    # Hash and place share one long, so that the sort stays on primitives; equal leading bits give a
    # superset of the repeats, whose words are compared afterwards.
    head = F.lit(~LOW_31).cast("bigint")
    packed = F.transform("_triples", lambda h, i: h.bitwiseAND(head).bitwiseOR(i.cast("bigint")))
    repeats = F.size(F.array_distinct("_triples")) < F.size("_triples")
    step = step.select(*found, "_words", F.when(repeats, F.sort_array(packed)).otherwise(none).alias("_packed"))

    def doubled(values: str, same) -> Column:
        """Members that equal a neighbour in a sorted array."""
        return F.filter(
            values, lambda v, i: F.coalesce(same(F.get(values, i - 1), v), F.lit(False)) | F.coalesce(same(F.get(values, i + 1), v), F.lit(False))
        )

    alike = doubled("_packed", lambda a, b: (a.bitwiseXOR(b)).bitwiseAND(head) == 0)

    def windows(v: Column) -> Column:
        at = v.bitwiseAND(F.lit(LOW_31).cast("bigint")).cast("int")
        return F.struct(*[F.get("_words", at + k).alias(f"w{k}") for k in range(3)], at.alias("at"))

    step = step.select(*found, F.sort_array(F.transform(alike, windows)).alias("_candidates"))
    exact = doubled("_candidates", lambda a, b: (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"]))
    covered = F.flatten(F.transform(exact, lambda s: F.array(s["at"], s["at"] + 1, s["at"] + 2)))
    step = step.select(*found, F.size(F.array_distinct(covered)).cast("bigint").alias("n_repeat_words"))
    # Behind a generator, no later filter is pushed into these nested expressions and repeats them.
    names = [c for c in step.columns if c not in kept]
    return step.select(*kept, F.explode(F.array(F.struct(*names))).alias("_found")).select(*kept, *[f"_found.{c}" for c in names])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What the conditions of the list may test; all are 0 for a text without words."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "symbols_per_char": F.col("n_symbols") / chars,
        "capitals_per_char": F.col("n_upper") / chars,
        "chars_per_word": F.col("word_chars") / words,
        "duplicate_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / words,
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, row: dict[str, float]) -> bool:
        return (row[self.feature] > self.cut) == self.above


@dataclass(frozen=True)
class Rule:
    """If all conditions hold, the document goes."""

    conditions: tuple[Condition, ...]

    def covers(self, row: dict[str, float]) -> bool:
        return all(c.holds(row) for c in self.conditions)


def _counts(rule: Rule, rows: list[tuple[dict, int]]) -> tuple[int, int]:
    covered = [bad for row, bad in rows if rule.covers(row)]
    return sum(covered), len(covered) - sum(covered)


def _cuts(rows: list[tuple[dict, int]], feature: str) -> list[float]:
    """Cut points between neighbouring quantiles of a feature."""
    values = sorted({row[feature] for row, _ in rows})
    picks = sorted({round(i * (len(values) - 1) / CUTS) for i in range(CUTS + 1)}) if values else []
    return [(values[a] + values[a + 1]) / 2 for a in picks if a + 1 < len(values)]


def _grow(rows: list[tuple[dict, int]], names: list[str], most: int = 3) -> Rule:
    """Adds the condition with the largest information gain until only bad rows are covered."""
    rule, inside = Rule(()), rows
    while len(rule.conditions) < most:
        bad = sum(b for _, b in inside)
        if not bad or bad == len(inside):
            break
        before, best, best_gain = math.log2(bad / len(inside)), None, 1e-9
        for name in names:
            for cut in _cuts(inside, name):
                for above in (True, False):
                    p = n = 0
                    for row, b in inside:
                        if (row[name] > cut) == above:
                            p, n = p + b, n + 1 - b
                    if p and (gain := p * (math.log2(p / (p + n)) - before)) > best_gain:
                        best, best_gain = Condition(name, above, cut), gain
        if best is None:
            break
        rule = Rule((*rule.conditions, best))
        inside = [(row, b) for row, b in inside if best.holds(row)]
    return rule


def _prune(rule: Rule, rows: list[tuple[dict, int]]) -> Rule:
    """Drops final conditions while that does not worsen (bad - good) / covered on other rows."""

    def worth(r: Rule) -> float:
        bad, good = _counts(r, rows)
        return (bad - good) / (bad + good) if bad + good else -1.0

    while len(rule.conditions) > 1 and worth(shorter := Rule(rule.conditions[:-1])) >= worth(rule):
        rule = shorter
    return rule


def learn_list(rows: list[tuple[dict, int]], names: list[str], precision: float = 0.75, most: int = 12) -> list[Rule]:
    """Sequential covering: two thirds grow a rule, one third prunes it; covered rows then leave."""
    grow, prune = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    rules: list[Rule] = []
    while len(rules) < most and sum(b for _, b in grow) >= 5:
        rule = _prune(_grow(grow, names), prune)
        bad, good = map(sum, zip(_counts(rule, grow), _counts(rule, prune), strict=True))
        if not rule.conditions or bad < 5 or bad < precision * (bad + good):
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not rule.covers(r[0])] for part in (grow, prune))
    return rules


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list[Rule]:
    """The list from at most ``rows`` labelled documents outside the held-out fold.

    Documents that fail the base are left out, as the list never judges them.
    """
    known = labels.where(trainable(F.col("doc_id")) & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    measured = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    own = features()
    found = measured.where(~base_failed()).select("doc_id", "quality", *[c.alias(n) for n, c in own.items()])
    got = sorted(found.collect(), key=lambda r: (r["doc_id"], tuple(r)[1:]))  # bounded by ``rows``
    return learn_list([({n: r[n] for n in own}, 1 - int(r["quality"] > 0)) for r in got], list(own))


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression; true keeps the document."""
    own, out = features(), F.when(base_failed(), F.lit(False))
    for rule in rules:
        test = F.lit(True)
        for c in rule.conditions:
            test = test & ((own[c.feature] > c.cut) if c.above else (own[c.feature] <= c.cut))
        out = out.when(test, F.lit(False))
    return out.otherwise(F.lit(True))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = learn(docs, read(spark, sf_dir, "labels"))
    judged = with_statistics(docs.select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), verdict(rules).alias("kept")
    )
