"""F17, mined: line patterns from a template tree of fixed depth.

Masked lines (``logfields.mask_template``) are cut into tokens at spaces. The
tree's first level is the number of tokens, the next ``depth`` levels are the
leading tokens; a node with more than ``max_children`` different next tokens
sends them all to one wildcard child. In a leaf, a position where all lines
agree is fixed. If at least ``similarity`` of the positions are fixed, the leaf
is one pattern, wildcards elsewhere; if not, only positions with more than
``max_values`` different tokens become wildcards and the other tokens tell the
leaf's patterns apart.

Every step is a distinct or a count over masked lines: nothing depends on the
order of rows or on how they are partitioned, and parts mined as (token,
position) sets could be united. Lines stay where they are: what a step finds
out about nodes and leaves is a small table, written once under the shared
folder and joined to the lines by the next. Most positions hold many different
tokens, which 64 bits per position show; only the others' tokens are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions.common import explode_rows, let
from capstream.functions.logfields import PLACEHOLDER, mask_template
from capstream.operators.timeseries import bucket_of
from capstream.session import shared_path


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def template_tree(lines: DataFrame, masked: str = "masked", depth: int = 2, max_children: int = 16, max_values: int = 4,
                  similarity: float = 0.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """``masked`` and ``pattern`` of every different masked line (NULL lines have none).

    With ``keep``: of every row, with these columns; NULL lines have the NULL
    pattern. ``lines`` are read once per step then and should be a stored table.
    """
    if not keep:
        lines = _written(lines.select(masked).where(F.col(masked).isNotNull()).distinct(), "template-lines")
    rows = lines.select(masked, *keep)
    tokens = F.split(F.col(masked), " ")
    nodes = rows.select("*", F.size(tokens).alias("_n"), F.array().cast("array<string>").alias("_path"))
    for level in range(depth):
        word = F.get(F.split(F.col(masked), " ", level + 2), F.lit(level))
        # lines shorter than the level end on the level above
        wide = _written(nodes.where(F.col("_n") > level).select("_n", "_path", word.alias("_c")).distinct()
                        .groupBy("_n", "_path").agg(F.count(F.lit(1)).alias("_children"))
                        .where(F.col("_children") > max_children).select("_n", "_path", F.lit(True).alias("_wide")), f"template-level{level}")
        step = F.when(F.col("_wide"), F.lit(PLACEHOLDER)).otherwise(word)
        nodes = nodes.join(wide, ["_n", "_path"], "left").select(
            *rows.columns, "_n", F.when(F.col("_n") > level, F.array_append("_path", step)).otherwise(F.col("_path")).alias("_path"))
    there = nodes.where(F.col(masked).isNotNull())
    # a bit per hash: more bits than ``enough`` are more tokens than ``enough``
    enough = max(int(max_values), 1)
    bits = F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(_v), 64) as int))"))
    spots = _written(explode_rows(there, tokens, ("_v",), keep=("_n", "_path"), pos="_i").groupBy("_n", "_path", "_i")
                     .agg((F.bit_count(bits) > enough).alias("_many")), "template-spots")
    open_spots = _written(spots.where(~F.col("_many")).groupBy("_n", "_path").agg(F.sort_array(F.collect_list("_i")).alias("_open")), "template-open")
    left = let(tokens, lambda t: F.transform("_open", lambda i: F.struct(i.alias("_i"), F.get(t, i).alias("_v"))))
    counted = (explode_rows(there.join(open_spots, ["_n", "_path"]), left, ("_x",), keep=("_n", "_path")).select("_n", "_path", "_x._i", "_x._v").distinct()
               .groupBy("_n", "_path", "_i").agg(F.count(F.lit(1)).alias("_d")))
    values = counted.unionByName(spots.where("_many").select("_n", "_path", "_i", F.lit(enough + 1).cast("bigint").alias("_d")))
    found = values.groupBy("_n", "_path").agg(F.sum((F.col("_d") == 1).cast("int")).alias("_fixed"),
                                              F.sort_array(F.collect_list(F.struct("_i", "_d"))).alias("_p"))
    alike = F.col("_fixed") >= F.lit(float(similarity)) * F.col("_n")

    def wild(p: Column) -> Column:
        d = p["_d"]
        return F.when(alike, d > 1).otherwise(d > max_values) | F.coalesce(F.get("_path", p["_i"]) == PLACEHOLDER, F.lit(False))

    leaves = _written(found.select("_n", "_path", F.transform("_p", wild).alias("_wild")), "template-leaves")
    pattern = F.zip_with(tokens, "_wild", lambda t, w: F.when(w, F.lit(PLACEHOLDER)).otherwise(t))
    return nodes.join(leaves, ["_n", "_path"], "left").select(*rows.columns, F.array_join(pattern, " ").alias("pattern"))


def mined_patterns(df: DataFrame, step_ms: int, ts: str = "ts", line: str = "line", **tree) -> DataFrame:
    """``pattern``, ``bucket_start``, ``count`` and the pattern's ``total``; NULL lines have the NULL pattern.

    ``tree`` are the parameters of ``template_tree``. Lines are counted per masked
    line and step first; only those counts go through the tree.
    """
    counts = _written(df.groupBy(mask_template(F.col(line)).alias("masked"), bucket_of(df, ts, step_ms).alias("bucket_start"))
                      .agg(F.count(F.lit(1)).alias("count")), "masked-lines")
    per_step = template_tree(counts, keep=("bucket_start", "count"), **tree).groupBy("pattern", "bucket_start").agg(F.sum("count").alias("count"))
    # one row per (pattern, step): the window holds a pattern's steps, not its lines
    return per_step.withColumn("total", F.sum("count").over(Window.partitionBy("pattern")))
