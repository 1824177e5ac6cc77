"""Quality rules: a learned decision list over document statistics, in DataFrame operations only.

Statistics are column expressions over whole texts. The learner is sequential covering: a rule grows
one threshold condition at a time by information gain on the grow rows, is cut back to its best
prefix on the prune rows, and the rows it covers leave before the next rule. Every step is one
aggregation of (feature, bin) counts over all labelled rows that the rule covers so far; the driver sees those
counts only (features x bins). The result is an ordered ``when ... when ... otherwise``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Statistics that rules may test (ratios, so that a rule does not depend on a text's length alone).
FEATURES = ["n_words", "mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "distinct_ratio", "upper_ratio", "digit_ratio", "mark_ratio"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WORKING = ["_t", "_w", "_n", "_b", "_s", "_d", "_r", "_lines"]

_POSITION = "int(_s[{k}] & _b)"
#: Neighbours k and k + 1 in the sorted windows have equal hashes, and equal words.
_SAME = "((_s[k] ^ _s[k + 1]) & ~_b) = 0 and " + " and ".join(
    f"_w[{_POSITION.format(k='k')} + {i}] = _w[{_POSITION.format(k='k + 1')} + {i}]" for i in range(3)
)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the columns of COUNTS and FEATURES; null texts have no words, and ratios over nothing are 0.

    A 3-word window is found again by sorting (hash of its words, position) packed in one long; equal
    neighbours are compared word by word. Columns of these names that ``docs`` has already are replaced.
    """
    out = docs.withColumn("_t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = out.withColumn("_w", F.array_remove(F.split("_t", "[\\x20\\x09-\\x0D]+"), "")).withColumn("_n", F.size("_w"))
    # _b: a mask of as many low bits as the word count needs, for positions
    out = out.withColumn("_b", F.expr("shiftleft(1L, int(length(bin(_n)))) - 1"))
    window = "sort_array(transform(sequence(0, _n - 3), i -> (xxhash64(_w[i], _w[i + 1], _w[i + 2]) & ~_b) | i))"
    out = out.withColumn("_s", F.expr(f"case when _n >= 4 then {window} else cast(array() as array<bigint>) end"))
    out = out.withColumn("_d", F.expr(f"case when _n >= 4 then filter(sequence(0, _n - 4), k -> {_SAME}) else cast(array() as array<int>) end"))
    out = out.withColumn("_r", F.expr("sort_array(array_distinct(concat(transform(_d, k -> _s[k] & _b), transform(_d, k -> _s[k + 1] & _b))))"))
    out = out.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))

    def counted(chars: str) -> Column:
        return F.length(F.regexp_replace("_t", f"[^{chars}]+", "")).cast("long")

    covered = "aggregate(sequence(0, size(_r) - 2), 3L, (acc, k) -> acc + least(3L, _r[k + 1] - _r[k]))"
    out = out.withColumns({
        "n_words": F.col("_n").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": counted("#*$%&|<>"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr(f"case size(_r) when 0 then 0L when 1 then 3L else {covered} end"),
    })

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    out = out.withColumns({
        "mean_word": ratio(F.col("word_chars"), F.col("n_words")),
        "symbol_ratio": ratio(F.col("n_symbols"), F.col("n_words")),
        "dup_line_ratio": ratio(F.col("n_dup_lines"), F.size("_lines")),
        "repeat_ratio": ratio(F.col("n_repeat_words"), F.col("n_words")),
        "distinct_ratio": ratio(F.size(F.array_distinct("_w")), F.col("n_words")),
        "upper_ratio": ratio(counted("A-Z"), F.col("word_chars")),
        "digit_ratio": ratio(counted("0-9"), F.col("word_chars")),
        "mark_ratio": ratio(counted("!?"), F.col("n_words")),
    })
    return out.drop(*_WORKING)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > F.lit(self.cut) if self.above else F.col(self.feature) <= F.lit(self.cut)


Rule = list[Condition]


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def decision_list(rules: list[Rule]) -> Column:
    """True (kept) unless a rule fires; the rules are tried in order."""
    if not rules:
        return F.lit(True)
    out = F.when(covers(rules[0]), F.lit(False))
    for rule in rules[1:]:
        out = out.when(covers(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    if not p1 or not p0:
        return 0.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def learn_rules(labelled: DataFrame, bad: str, features: list[str] = FEATURES, bins: int = 32, max_rules: int = 8,
                max_conditions: int = 4, min_precision: float = 0.95, min_cover: int = 8) -> list[Rule]:
    """Rules for rows whose boolean column ``bad`` is true, in the order found.

    ``min_precision`` (on the prune rows, and on the grow rows) decides when to stop: a list that rejects clean rows is worse
    than one rule fewer. Of equal gains the first in (feature, direction, cut) order wins, so the list does not
    depend on partitioning. Rows with a null label are ignored; without labelled rows, or with
    one class only, there are no rules.
    """
    rows = labelled.where(F.col(bad).isNotNull()).select(F.col(bad).cast("boolean").alias("bad"), *[F.col(f).cast("double").alias(f) for f in features])
    probs = F.array(*[F.lit(i / bins) for i in range(bins)])
    found = rows.agg(*[F.percentile_approx(f, probs, F.lit(10_000)).alias(f) for f in features],
                     # cuts between the classes' bulk: also the quantiles of the bad rows alone
                     *[F.percentile_approx(F.when(F.col("bad"), F.col(f)), probs, F.lit(10_000)).alias(f"{f}!") for f in features]).first()
    cuts = {f: sorted({*(found[f] or []), *(found[f"{f}!"] or [])}) for f in features}
    binned = rows.select(
        "bad", (F.pmod(F.xxhash64(*features), F.lit(3)) < 2).alias("grow"),
        *[sum((F.when(F.col(f) > F.lit(c), 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias(f) for f in features],
    ).checkpoint()

    def column(c: Condition) -> Column:
        k = cuts[c.feature].index(c.cut)
        return F.col(c.feature) > k if c.above else F.col(c.feature) <= k

    def fires(rule: Rule) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & column(c)
        return out

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        rule: Rule = []
        while len(rule) < max_conditions:
            pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("k")) for f in features])).alias("x")
            table = (
                binned.where(left & F.col("grow") & fires(rule)).select("bad", pairs)
                .groupBy("x.f", "x.k").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
            )
            at = {f: {} for f in features}
            for r in table:
                at[r["f"]][r["k"]] = (r["p"], r["n"])
            p0, n0 = (sum(v[i] for v in at[features[0]].values()) for i in (0, 1))
            best = (0.0, None, None)
            for f in features:
                p = n = 0
                for k, cut in enumerate(cuts[f]):
                    dp, dn = at[f].get(k, (0, 0))
                    p, n = p + dp, n + dn
                    for above, (p1, n1) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                        gain = _gain(p0, n0, p1, n1)
                        if p1 >= min_cover and gain > best[0] + 1e-9:
                            best = (gain, Condition(f, above, cut), (p1, n1))
            if best[1] is None:
                break
            rule.append(best[1])
            if best[2][1] == 0:
                break
        if not rule:
            break
        # cut back to the best prefix on the prune rows; of equal values the shortest
        tests = [F.count_if(fires(rule[:k]) & (F.col("bad") == b) & (F.col("grow") == g)) for k in range(1, len(rule) + 1) for g in (False, True) for b in (True, False)]
        got = binned.where(left).agg(*[t.alias(f"t{i}") for i, t in enumerate(tests)]).first()
        scored = []
        for k in range(1, len(rule) + 1):
            p, n, gp, gn = (got[4 * (k - 1) + i] for i in range(4))
            scored.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n, gp, gn))
        value, k, p, n, gp, gn = max(scored)
        if p < min_cover / 2 or p < min_precision * (p + n) or gp < min_precision * (gp + gn):
            break
        rules.append(rule[:-k])
        left = left & ~fires(rule[:-k])
    return _centred(rows, rules)


def _centred(rows: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Each threshold half way between the labelled values next to it on either side: no labelled row changes sides."""
    conditions = list(dict.fromkeys(c for rule in rules for c in rule))
    if not conditions:
        return rules
    sides = [f(F.when(side, F.col(c.feature))) for c in conditions for f, side in ((F.max, F.col(c.feature) <= c.cut), (F.min, F.col(c.feature) > c.cut))]
    got = rows.agg(*[x.alias(f"s{i}") for i, x in enumerate(sides)]).first()
    moved = {}
    for i, c in enumerate(conditions):
        low, high = got[2 * i], got[2 * i + 1]
        cut = c.cut if low is None or high is None or not low < (low + high) / 2 < high else (low + high) / 2
        moved[c] = Condition(c.feature, c.above, cut)
    return [[moved[c] for c in rule] for rule in rules]


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[Rule]]:
    """(id, COUNTS, FEATURES, base_failed, kept) of each row, and the rules learned from ``labels`` (id, quality 0/1).

    The list is learned on labelled rows that pass the base rule, as it only decides those.

    Defined cases: null texts count as empty and fail the base rule; several labels of an id count as
    bad if any is 0; a null quality is no label; rows of an id are judged one by one by their text; rows with a null
    id are judged but never used for learning; without usable labels the base rule alone decides; an
    empty table gives an empty one; further columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    stats = with_statistics(rows).drop("text").withColumn("base_failed", base_failed()).checkpoint()
    marks = labels.where("quality is not null").groupBy(F.col(id_col).alias("id")).agg((F.min("quality") == 0).alias("bad"))
    rules = learn_rules(stats.where(~F.col("base_failed")).join(marks, "id"), "bad")
    out = stats.withColumn("kept", ~F.col("base_failed") & decision_list(rules))
    return out.withColumnRenamed("id", id_col), rules


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that base rule and learned list keep, with their columns.

    The statistics are computed again beside the texts: cheaper than moving the texts to join a verdict.
    """
    _, rules = quality_verdicts(docs, labels, id_col, text_col)
    renamed = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_col)}"
    judged = with_statistics(renamed, text).withColumn("kept", ~base_failed() & decision_list(rules))
    # behind a generator the filter stays above the statistics; pushed below, it would compute them over and over
    carried = [c for c in renamed.columns]
    kept = judged.select(*carried, F.explode(F.array("kept")).alias("kept")).where("kept")
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Statistics, base rule and learned verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out, _ = quality_verdicts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept")
