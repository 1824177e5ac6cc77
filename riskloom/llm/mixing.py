"""Mixing sources to target weights: temperature, then budgeted block permutations.

Source i with token share p_i gets the weight p_i^a / sum p_j^a. The exponent a in [0, 1] (1: shares as they are, 0: all
equal) is bisected until a target is met: the weights' entropy, or the limit on how often any source repeats.
A token budget times the weight is a source's budget: whole passes, and a rest. In each pass (epoch) the source's blocks
of documents come in an own random order, by hash of (epoch, source, block); the rest takes blocks in that order until the
budget is filled, and documents of the last block likewise. All steps are aggregations, joins and windows of bounded
groups (documents of a block, blocks of a run, runs of a source).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Documents of a block, and blocks of a run, about.
BLOCK_DOCS = 32
RUN_BLOCKS = 1024
#: Sections of the exponent's interval that one pass over the source totals tells apart.
SECTIONS = 16


def _exponent(shares: DataFrame, budget_ratio: float, entropy: float | None, max_repeat: float | None, tolerance: float) -> float:
    """The largest exponent with at least ``entropy`` (nats), or the least with at most ``max_repeat`` passes of any source.

    Entropy falls and the largest repetition falls as the exponent rises, so either target has one crossing. An
    unreachable target gives the nearer end.
    """

    def measure(a: float) -> list[Column]:
        power = F.exp(F.lit(a) * F.ln("p"))
        return [F.sum(power), F.sum(power * F.ln("p")), F.max(F.exp(F.lit(a - 1.0) * F.ln("p")))]

    low, high = 0.0, 1.0
    while high - low > tolerance:
        probes = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        got = shares.agg(*[c.alias(f"m{i}_{k}") for i, a in enumerate(probes) for k, c in enumerate(measure(a))]).first()
        if got["m0_0"] is None:
            return 1.0
        met = []
        for i, a in enumerate(probes):
            s, t, m = got[f"m{i}_0"], got[f"m{i}_1"], got[f"m{i}_2"]
            met.append(math.log(s) - a * t / s >= entropy - 1e-12 if entropy is not None else m / s * budget_ratio <= max_repeat + 1e-12)
        if entropy is not None:  # met at small exponents
            if met[-1]:
                return probes[-1]
            if not met[0]:
                return probes[0]
            k = max(i for i, x in enumerate(met) if x)
            low, high = probes[k], probes[k + 1]
        else:  # met at large exponents
            if met[0]:
                return probes[0]
            if not met[-1]:
                return probes[-1]
            k = min(i for i, x in enumerate(met) if x)
            low, high = probes[k - 1], probes[k]
    return low if entropy is not None else high


def mixture(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", entropy: float | None = None,
            max_repeat: float | None = None, budget_ratio: float = 1.0, seed: int = 0, tolerance: float = 1e-6) -> tuple[DataFrame, DataFrame]:
    """(instances, weights). One of ``entropy`` (nats) and ``max_repeat`` (passes) is the target.

    instances: one row per time that a document is taken: _source, _k1, _k2 (what identifies the document: hashes of id and text),
    _epoch, _position (tokens of the source's epoch before it), _tokens. weights: _source, tokens, docs, exponent, weight,
    budget, epochs (whole passes), rest. ``budget_ratio``: total budget over total tokens.
    Defined cases: see ``mix``.
    """
    if (entropy is None) == (max_repeat is None):
        raise ValueError("give one of entropy and max_repeat")
    ensure_checkpoint_dir(docs.sparkSession)
    rows = keyed(docs, source_col, id_col, text_col).groupBy("_source", "_k1", "_k2").agg(F.sum("_tokens").alias("_tokens")).checkpoint()
    sources = rows.groupBy("_source").agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("docs")).where("tokens > 0").checkpoint()
    total = sources.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    a = _exponent(sources.select((F.col("tokens") / F.lit(total or 1)).alias("p")), budget_ratio, entropy, max_repeat, tolerance)
    raised = sources.withColumn("_w", F.exp(F.lit(a) * F.ln(F.col("tokens") / F.lit(total or 1))))
    whole = raised.agg(F.sum("_w").alias("s")).first()["s"] or 1.0
    weights = (
        raised.withColumn("exponent", F.lit(a)).withColumn("weight", F.col("_w") / F.lit(whole)).drop("_w")
        .withColumn("budget", F.round(F.col("weight") * F.lit(budget_ratio * total)).cast("long"))
        .withColumn("epochs", F.expr("budget div tokens").cast("int"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    ).checkpoint()
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCS))
    placed = rows.join(weights.select("_source", "docs", "epochs", "rest"), "_source").withColumn("_block", F.pmod("_k1", n_blocks)).checkpoint()

    epoch = F.explode(F.sequence(F.lit(0), F.col("epochs"))).alias("_epoch")
    blocks = placed.groupBy("_source", "_block").agg(F.sum("_tokens").alias("_bt"), F.first("epochs").alias("epochs"), F.first("rest").alias("rest"), F.first("docs").alias("docs"))
    turns = blocks.select("*", epoch).where("_epoch < epochs or rest > 0").withColumn("_o", F.xxhash64(F.lit(seed), "_epoch", "_source", "_block"))
    runs = F.greatest(F.lit(1), F.ceil(F.col("docs") / (BLOCK_DOCS * RUN_BLOCKS)))
    turns = turns.withColumn("_run", F.floor(F.shiftrightunsigned("_o", 33) / F.lit(float(1 << 31)) * runs)).withColumn("_o2", F.shiftrightunsigned("_o", 1)).checkpoint()
    per_run = turns.groupBy("_source", "_epoch", "_run").agg(F.sum("_bt").alias("_rt"))
    before = lambda v, *by: F.coalesce(F.sum(v).over(W.partitionBy(*by[0]).orderBy(*by[1]).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    per_run = per_run.select("_source", "_epoch", "_run", before("_rt", ["_source", "_epoch"], ["_run"]).alias("_r0"))
    starts = (
        turns.withColumn("_b0", before("_bt", ["_source", "_epoch", "_run"], ["_o2", "_o", "_block"]))
        .join(per_run, ["_source", "_epoch", "_run"]).withColumn("_start", F.col("_r0") + F.col("_b0"))
        .where("_epoch < epochs or _start < rest").select("_source", "_block", "_epoch", "_start")
    )
    one = placed.join(starts, ["_source", "_block"]).withColumn("_o", F.xxhash64(F.lit(seed), "_epoch", "_k1", "_k2"))
    one = one.withColumn("_position", (F.col("_start") + before("_tokens", ["_source", "_epoch", "_block"], ["_o", "_k1", "_k2"])).cast("long"))
    taken = one.where("_epoch < epochs or _position < rest")
    return taken.select("_source", "_k1", "_k2", "_epoch", "_position", "_tokens"), weights


def keyed(docs: DataFrame, source_col: str, id_col: str, text_col: str, carried: list[Column] = []) -> DataFrame:
    """Source (null is one of its own), two 64-bit hashes of id and text, the words of each row, and the ``carried`` columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""))
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    return docs.select(source.alias("_source"), F.xxhash64(F.col(id_col), text).alias("_k1"), F.xxhash64(text, F.col(id_col), F.lit(1)).alias("_k2"),
                       words.cast("long").alias("_tokens"), *carried)


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **target) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, with ``epoch`` and ``position`` (tokens of the source's epoch before).

    Tokens are words. Targets are those of ``mixture``.

    Defined cases: a null source is a source of its own; a null text has no words, and a row without words weighs nothing and
    is taken with its block; a source without any words has no share and is not taken; rows equal in source, id and text
    are taken together; an empty table gives an empty one; further columns are carried, columns named like a
    result are replaced.
    """
    names = [c for c in docs.columns if c not in ("epoch", "position")]
    taken, _ = mixture(docs, source_col, id_col, text_col, **target)
    own = keyed(docs, source_col, id_col, text_col, [F.col(c).alias(f"c{k}") for k, c in enumerate(names)])
    out = own.drop("_tokens").join(taken, ["_source", "_k1", "_k2"])
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], F.col("_epoch").alias("epoch"), F.col("_position").alias("position"))


#: Passes that the smallest source may make at most, in the query and the pipeline.
MAX_REPEAT = 1.25


def op6_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture takes them: no source passes more than 1.25 times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs, max_repeat=MAX_REPEAT).drop("text")
