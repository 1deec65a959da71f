"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit per
failed rule, so a policy (a named, versioned set of rules) is one bitwise test over the ledger,
and an ablation (what would each rule's absence keep?) is an aggregation over the few distinct
bit patterns: neither reads the texts again.

Work per document is linear but for one sort of its windows; nothing is shuffled to build the
ledger or to apply a policy.

Edge cases: a null text counts as empty and has no words, so it fails ``few_words``. Rows are
judged one by one: repeated rows and ties get equal results, null ids pass through, an empty
table gives an empty ledger. Columns of the input that clash with a ledger column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import WHITE, WHITE_RUN, let, prefixed, text_or_empty

SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

#: Rule name and failing condition over the measurements; the position is the rule's bit and
#: never changes, so that stored ledgers stay readable. New rules are appended.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbol_heavy", "3 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 80 * n_lines AND n_lines >= 10"),
    ("short_mean_word", "word_chars < 2 * n_words"),
    ("long_mean_word", "word_chars > 25 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned set of rules; a document is kept if it fails none of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
PRODUCTION = Policy("2", tuple(BIT))


def _measurements(text: Column) -> Column:
    """All measurements of one text as a struct."""

    def repeated(words: Column) -> Column:
        windows = F.when(
            F.size(words) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - WINDOW),
                lambda i: F.struct(
                    F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("p")
                ),
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))

        def positions(found: Column) -> Column:
            def twice(x: Column, i: Column) -> Column:
                before, after = F.get(found, i - 1)["h"], F.get(found, i + 1)["h"]
                return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

            return F.sort_array(F.transform(F.filter(found, twice), lambda x: x["p"]))

        return F.aggregate(
            let(F.sort_array(windows), positions),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(
                p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    words = F.filter(F.split(text, WHITE_RUN), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.char_length(F.array_join(w, "")).alias("word_chars"),
            repeated(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")
        ),
    )
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
    )


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus measurements and ``failed_rules``, a long with the bit of each failed rule."""
    measured = {
        "n_words": "w.n_words",
        "word_chars": "w.word_chars",
        "n_symbols": "n_symbols",
        "n_lines": "l.n_lines",
        "n_dup_lines": "l.n_dup_lines",
        "n_repeat_words": "w.n_repeat_words",
    }
    others = [F.col(f"`{c}`") for c in docs.columns if c not in measured and c != "failed_rules"]
    held = "__measured"
    while held in docs.columns:
        held += "_"
    out = docs.withColumn(held, _measurements(text_or_empty(F.col(f"`{text_col}`")))).select(
        *others, *[F.col(f"{held}.{path}").cast("long").alias(name) for name, path in measured.items()]
    )
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(0) for name, rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return out.withColumn("failed_rules", failed.cast("long"))


def passes(policy: Policy) -> Column:
    return F.col("failed_rules").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    # Under other names no column of the caller's is replaced by a measurement.
    held, own = prefixed(docs, docs.columns, "own_")
    kept = ledger(held, "own_text").where(passes(policy))
    return kept.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(own, docs.columns, strict=True)])


def ablation(ledgers: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents that only it removes.

    The ledger shrinks to one row per bit pattern, at most 2^rules, before anything is
    taken apart.
    """
    patterns = (
        ledgers.select(F.col("failed_rules").bitwiseAND(F.lit(policy.mask)).alias("pattern"))
        .groupBy("pattern")
        .agg(F.count("*").alias("n"))
    )
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]
    )
    each = patterns.select("pattern", "n", F.inline(rules))
    has = F.col("pattern").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("pattern") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("pattern").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias(
            "n_kept_without"
        ),
    )
