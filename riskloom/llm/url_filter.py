"""URL filter: listed rules first, then a path-template tree learned per host. DataFrame and SQL functions only.

The tree grows level by level over the distinct (host, path shape) rows with their counts. At each node

* digits in a segment become ``#``, and segment values of few pages become the wildcard ``*`` where the node has
  many of them (an id, a slug);
* the other values are branches. Those with enough labels are put into cells by their smoothed share of bad
  labels, and neighbouring cells whose shares a two-proportion test cannot tell apart are one branch from
  there on, so their subtrees are counted together.

A leaf is a template. It is rejected when the share of bad labels, smoothed towards the share of all labels, is high and rests on
enough labels of its own. Every step is an aggregation over shapes and a join back that spreads hot nodes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.skew import join_spread
from riskloom.session import ensure_checkpoint_dir

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``block`` or allow what lies under ``host`` and its subdomains and has a path that starts with ``path``."""

    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """Parameters: segments of a template (the rest of a longer path is one more, ``**``); pages from which a segment value
    is a branch anyway; rarer values of a node from which they are a wildcard; labels from which a branch may merge, cells of
    the share, and the test's bound; labels, prior weight and share from which a template is rejected."""

    depth: int = 8
    own_pages: int = 16
    wild_values: int = 16
    merge_labels: int = 8
    cells: int = 20
    alike: float = 1.96
    reject_labels: int = 16
    prior: float = 4.0
    reject_share: float = 0.9


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), "^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule], value) -> Column:
    """``value`` of the longest rule that fits (of equal lengths that with the longer host), else null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(value(r))) if out is None else out.when(fits, F.lit(value(r)))
    return F.lit(None) if out is None else out


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def shape_of(path: Column, depth: int) -> Column:
    """The segments of a path, digits as ``#``; what lies beyond ``depth`` is one segment ``**``."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    segments = F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    return F.when(F.size(segments) > depth, F.concat(F.slice(segments, 1, depth), F.array(F.lit("**")))).otherwise(segments)


def templates(pages: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """(host, shape, template, n_bad, n_labelled, share) of every distinct host and shape.

    ``pages`` has host, shape (segments, see ``shape_of``) and the label ``bad`` (boolean, null: none). n_bad, n_labelled and the smoothed
    ``share`` are those of the template. A merged branch is named after its smallest member and the number of the others.
    """
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/templates-{uuid.uuid4().hex}"
    rows = pages.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.count("bad").alias("n_labelled"))
    rows = _written(rows.withColumn("node", F.lit("")), f"{folder}/level=0")
    ended, k = [], 0
    while not rows.isEmpty():
        ended.append(rows.where(F.size("shape") <= k))
        rows = rows.where(F.size("shape") > k).withColumn("segment", F.element_at("shape", k + 1))
        sums = [F.sum(c).alias(c) for c in ("n", "n_bad", "n_labelled")]
        child = rows.groupBy("host", "node", "segment").agg(*sums)
        rare = (F.col("n") < tree.own_pages) & (F.col("segment") != "**")
        parent = child.groupBy("host", "node").agg(F.count_if(rare).alias("n_rare"), F.sum("n_bad").alias("p_bad"), F.sum("n_labelled").alias("p_labelled"))
        child = _written(child, f"{folder}/children-{k}")
        child = join_spread(child, parent, ["host", "node"], F.col("segment"))
        wild = rare & (F.col("n_rare") >= tree.wild_values)
        base = F.when(F.col("p_labelled") > 0, F.col("p_bad") / F.col("p_labelled")).otherwise(0.0)
        share = (F.col("n_bad") + tree.prior * base) / (F.col("n_labelled") + tree.prior)
        cell = F.least(F.floor(share * tree.cells), F.lit(tree.cells - 1)).cast("int")
        merges = ~wild & (F.col("n_labelled") >= tree.merge_labels) & (F.col("segment") != "**")
        child = _written(child.select("host", "node", "segment", "n_bad", "n_labelled", wild.alias("wild"), F.when(merges, cell).alias("cell")), f"{folder}/cells-{k}")
        # at most ``cells`` rows of a node: neighbours that the test cannot tell apart share a group
        cells = child.where("cell is not null").groupBy("host", "node", "cell").agg(
            F.sum("n_bad").alias("b"), F.sum("n_labelled").alias("t"), F.min("segment").alias("least"), F.count("*").alias("members"))
        order = Window.partitionBy("host", "node").orderBy("cell")
        b0, t0 = F.lag("b").over(order), F.lag("t").over(order)
        pooled = (F.col("b") + b0) / (F.col("t") + t0)
        gap = F.abs(F.col("b") / F.col("t") - b0 / t0)
        bound = tree.alike * F.sqrt(pooled * (1 - pooled) * (1 / F.col("t") + 1 / t0))
        cells = cells.withColumn("apart", F.when(b0.isNull() | (gap <= bound), 0).otherwise(1))
        cells = cells.withColumn("grp", F.sum("apart").over(order))
        whole = Window.partitionBy("host", "node", "grp")
        more = F.sum("members").over(whole) - 1
        least = F.min("least").over(whole)
        named = cells.select("host", "node", "cell", F.when(more > 0, F.concat(F.lit("("), least, F.lit("|+"), more.cast("string"), F.lit(")"))).otherwise(least).alias("branch"))
        literal = child.where("cell is null").select("host", "node", "segment", F.when(F.col("wild"), F.lit("*")).otherwise(F.col("segment")).alias("branch"))
        merged = join_spread(child.where("cell is not null").select("host", "node", "segment", "cell"), named, ["host", "node", "cell"], F.col("segment"))
        branch = _written(literal.unionAll(merged.select("host", "node", "segment", "branch")), f"{folder}/branches-{k}")
        rows = join_spread(rows, branch, ["host", "node", "segment"], F.concat_ws("/", "shape"))
        rows = _written(rows.select("host", "shape", "n", "n_bad", "n_labelled", F.concat("node", F.lit("/"), "branch").alias("node")), f"{folder}/level={k + 1}")
        k += 1
    leaves = ended[0] if ended else rows
    for part in ended[1:]:
        leaves = leaves.unionByName(part)
    leaves = _written(leaves.select("host", "shape", "node", "n_bad", "n_labelled"), f"{folder}/leaves")
    total = leaves.agg(F.sum("n_bad").alias("b"), F.sum("n_labelled").alias("t")).first()
    base = (total["b"] or 0) / total["t"] if total["t"] else 0.0
    sums = leaves.groupBy("host", "node").agg(F.sum("n_bad").alias("n_bad"), F.sum("n_labelled").alias("n_labelled"))
    sums = sums.withColumn("share", (F.col("n_bad") + F.lit(tree.prior * base)) / (F.col("n_labelled") + F.lit(tree.prior)))
    out = join_spread(leaves.select("host", "shape", "node"), sums, ["host", "node"], F.concat_ws("/", "shape"))
    return out.withColumnRenamed("node", "template")


def judge_urls(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
               tree: Tree = Tree()) -> DataFrame:
    """(id, host, path, rule, verdict, template, n_labelled, share) of every row of ``pages``.

    The longest rule that fits decides; otherwise the url's template does. Labels are the decisions of the rules, and where
    ``labels`` (id, ``bad`` boolean) has the row's id, those instead (several of one id: bad if any is).
    ``rules`` become one expression, so they should be a short list.

    Defined cases: a null url and one without ``://`` has an empty host and path, which is a host like any other; rows of one id are judged
    one by one; a null id has no label of its own; without labels nothing but the rules blocks; an empty table gives an empty one; a
    long path is cut into ``tree.depth`` segments and ``**``; further columns are ignored.
    """
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/urls-{uuid.uuid4().hex}"
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules, lambda r: r.name).cast("string"))
    rows = rows.withColumn("listed", longest_rule(F.col("host"), F.col("path"), rules, lambda r: r.block).cast("boolean"))
    if labels is None:
        rows = rows.withColumn("bad", F.col("listed"))
    else:
        own = labels.where("bad is not null").groupBy(F.col(id_col).alias("id")).agg(F.max("bad").alias("own"))
        rows = rows.join(own, "id", "left").withColumn("bad", F.coalesce("own", "listed")).drop("own")
    rows = _written(rows.withColumn("shape", shape_of(F.col("path"), tree.depth)), f"{folder}/rows")
    known = templates(rows.select("host", "shape", "bad"), tree)
    known = known.select("host", F.concat_ws("/", "shape").alias("key"), "template", "n_labelled", "share")
    judged = join_spread(rows.withColumn("key", F.concat_ws("/", "shape")), known, ["host", "key"], F.concat_ws(" ", "path", "id"))
    rejected = (F.col("n_labelled") >= tree.reject_labels) & (F.col("share") >= tree.reject_share)
    verdict = F.when(F.coalesce("listed", rejected), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "template", "n_labelled", "share")


#: The rules of the query.
RULES = [
    Rule("com", "/", False),
    Rule("example.com", "/en/", True),
    Rule("www.example.com", "/en/", False),
    Rule("net", "/es/", True),
    Rule("net", "/fr/", True),
]


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules and by the templates learned from what the rules decide."""
    out = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")
