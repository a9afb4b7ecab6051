r"""Quality rules: a decision list learned by sequential covering.

Built-in Spark expressions only. ``measure`` counts, per whole text, words
(``[^\x20\x09-\x0D]+``), their characters, symbols, lines that repeat an earlier
line, and words that stand in a three-word window found at least twice in the
text. Windows are compared inside the row: sorted by a hash, then those that
share a hash are sorted by their words, so that equal windows are neighbours;
time grows as n log n in a text's words and nothing is shuffled.

``learn`` makes an ordered list of rules that reject. A rule is a conjunction of
thresholds on the measured rates. It is *grown* on two thirds of the labelled
rows by information gain, *pruned* on the last third by dropping last conditions
while that does not lower its precision there, and kept if it is precise and
frequent enough on both. Rows it covers leave, and the next rule is grown. Each
step is one aggregation to (feature, bin, class) counts over all labelled rows;
the driver sees some hundred counts. ``verdict`` turns the list into one
``CASE WHEN`` expression.

Defined cases: a null text has no words; a text without words has rates of 0; a
null id has no label and is judged like others; repeated rows are judged one by
one; repeated labels of an id count as one, which rejects if any does; without
labels of both classes the list is empty and rejects nothing; empty tables give
empty results; further columns are ignored.
"""

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from basketstream.functions.once import add_once
from basketstream.llm.common import write_once

SPACE = r"[\\x20\\x09-\\x0D]"
FEATURES = {
    "symbol_rate": "n_symbols / n_words",
    "repeat_rate": "n_repeat_words / n_words",
    "dup_line_rate": "n_dup_lines / n_words",
    "shout_rate": "n_shouts / n_words",
    "word_length": "word_chars / n_words",
}
BINS = 32
MIN_PRECISION, MIN_ROWS = 0.97, 20


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}D"


def measure(docs: DataFrame, id_column="doc_id", text_column="text", carry=False) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_shouts (exclamation marks).

    With ``carry`` the whole row of ``docs`` comes along as the struct ``carried``.
    """
    rest = ["carried"] if carry else []
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
                        *([F.struct("*").alias("carried")] if carry else []))
    words = add_once(texts, "words", F.expr(f"filter(split(text, '{SPACE}+'), w -> w <> '')"))
    counted = words.selectExpr(
        *rest, "doc_id", "words", "cast(size(words) as long) AS n_words", "cast(length(array_join(words, '')) as long) AS word_chars",
        "cast(regexp_count(text, '[#*$%&|<>]') as long) AS n_symbols",
        "cast(length(text) - length(replace(text, '!', '')) as long) AS n_shouts",
        f"filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]') AS lines")
    counted = counted.withColumn("n_dup_lines", F.expr("cast(size(lines) - size(array_distinct(lines)) as long)")).drop("lines")
    # (hash of the window at word i, i), sorted: windows with equal hashes are neighbours.
    hashed = add_once(counted, "hashed", F.expr("""
        CASE WHEN n_words >= 3 THEN sort_array(transform(sequence(0, size(words) - 3),
             i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i))) END"""))
    shared = add_once(hashed, "shared", F.expr("""
        sort_array(transform(
            filter(hashed, (x, k) -> get(hashed, k - 1).h <=> x.h OR get(hashed, k + 1).h <=> x.h),
            x -> struct(concat_ws(' ', words[x.i], words[x.i + 1], words[x.i + 2]) AS w, x.i AS i)))""")).drop("hashed", "words")
    repeated = shared.withColumn("n_repeat_words", F.expr("""
        cast(coalesce(size(array_distinct(flatten(transform(
            filter(shared, (x, k) -> get(shared, k - 1).w <=> x.w OR get(shared, k + 1).w <=> x.w),
            x -> array(x.i, x.i + 1, x.i + 2))))), 0) as long)"""))
    return repeated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", *rest)


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def add_features(measured: DataFrame) -> DataFrame:
    return measured.withColumns(
        {name: F.expr(f"CASE WHEN n_words > 0 THEN {rate} ELSE 0D END") for name, rate in FEATURES.items()})


def covers(conditions) -> Column:
    return F.expr(" AND ".join(c.sql() for c in conditions) or "true")


def verdict(rules) -> Column:
    """Number of the first rule that covers the row, from 1 on, or null when none does."""
    value = F.lit(None).cast("int")
    for number in range(len(rules), 0, -1):
        value = F.when(covers(rules[number - 1]), F.lit(number)).otherwise(value)
    return value


def _histogram(rows: DataFrame):
    """{feature: {bin: [kept, rejected] on the growing rows}} in one aggregation."""
    names = ", ".join(f"'{n}', bin_{n}" for n in FEATURES)
    bins = rows.where("growing").selectExpr("reject", f"stack({len(FEATURES)}, {names}) AS (feature, bin)")
    out = {name: {} for name in FEATURES}
    for row in bins.groupBy("feature", "bin").agg(F.sum(1 - F.col("reject")).alias("keep"), F.sum("reject").alias("reject")).collect():
        out[row.feature][row.bin] = (row.keep, row.reject)
    return out


def _best(histogram, cuts, used):
    """The condition with the highest information gain, or None."""
    first = next(iter(histogram.values()))
    keep, reject = (sum(v[i] for v in first.values()) for i in (0, 1))
    if not reject or not keep:
        return None
    start, best = log2(reject / (keep + reject)), (0.0, None)
    for feature, bins in sorted(histogram.items()):
        below = [0, 0]
        for number, cut in enumerate(cuts[feature]):
            for i in (0, 1):
                below[i] += bins.get(number, (0, 0))[i]
            for above in (True, False):
                k, r = (keep - below[0], reject - below[1]) if above else below
                gain = r * (log2(r / (k + r)) - start) if r else 0.0
                condition = Condition(feature, above, cut)
                if gain > best[0] + 1e-9 and condition not in used:
                    best = gain, condition
    return best[1]


def _counts(rows: DataFrame, conditions):
    """[(rows covered, rejects among them) on growing and pruning rows] for every leading part of a rule."""
    parts = [conditions[: n + 1] for n in range(len(conditions))]
    sums = [F.sum(F.when(covers(part) & (F.col("growing") == growing), value).otherwise(0))
            for part in parts for growing in (True, False) for value in (F.lit(1), F.col("reject"))]
    values = [v or 0 for v in rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
    return [((values[i], values[i + 1]), (values[i + 2], values[i + 3])) for i in range(0, len(values), 4)]


def learn(measured: DataFrame, labels: DataFrame, id_column="doc_id", label_column="quality", bins=BINS,
          min_precision=MIN_PRECISION, min_rows=MIN_ROWS) -> list:
    """Ordered rules, each a tuple of conditions, that reject rows labelled 0. Rows that fail the base rules are left out."""
    wanted = labels.where(F.col(label_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col(label_column) == 0, 1).otherwise(0)).alias("reject"))
    rows = add_features(measured.drop("carried").where(~base_failed())).join(wanted, "doc_id").select(
        "reject", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("growing"), *FEATURES)
    rows = write_once(rows, "rule-rows")
    steps = [(i + 1) / (bins + 1) for i in range(bins)]
    # Rejected rows are the minority: quantiles of both classes give cuts where they part.
    found = {row.reject: row for row in rows.groupBy("reject").agg(
        *[F.percentile_approx(name, steps, 10000).alias(name) for name in FEATURES]).collect()}
    if set(found) != {0, 1}:
        return []
    cuts = {n: sorted({*found[0][n], *found[1][n]}) for n in FEATURES}
    binned = rows.select("*", *[
        F.expr(f"size(filter(array({', '.join(f'{c!r}D' for c in cuts[n])}), c -> c < {n}))").alias(f"bin_{n}") for n in FEATURES])
    left, rules = write_once(binned, "rule-bins"), []
    while True:
        rule = []
        while (new := _best(_histogram(left.where(covers(rule))), cuts, rule)):
            rule.append(new)
        if not rule:
            break
        counts = _counts(left, rule)
        precise = [r / n if n else 0.0 for _, (n, r) in counts]
        size = len(rule)
        while size > 1 and precise[size - 2] >= precise[size - 1]:
            size -= 1
        (grown, grown_rejects), (pruned, pruned_rejects) = counts[size - 1]
        if grown + pruned < min_rows or min(grown_rejects / max(grown, 1), pruned_rejects / max(pruned, 1)) < min_precision:
            break
        rules.append(tuple(rule[:size]))
        left = left.where(~covers(rule[:size]))
    return rules


def judge(measured: DataFrame, rules) -> DataFrame:
    """``measured`` with base_failed, rule (number of the rejecting rule or null) and kept."""
    judged = add_features(measured).withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop(*FEATURES)


def score_documents(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """Measures every text once, learns the list from the labelled rows and judges all rows by it."""
    measured = write_once(measure(docs, id_column, text_column), "measures")
    return judge(measured, learn(measured, labels, id_column))


def keep_good(docs: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """The rows of ``docs`` that neither the base rules nor the learned list reject, with the columns of ``docs``."""
    measured = write_once(measure(docs, id_column, text_column, carry=True), "measures", "zstd")
    return judge(measured, learn(measured, labels, id_column)).where("kept").select("carried.*")
