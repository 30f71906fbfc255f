"""Log exploration over ``(ts, labels map<string,string>, line)`` frames.

Filters are predicates Catalyst can push and combine; every summary is one
``groupBy`` with partial aggregation (distinct counts dedupe ``(name, value)``
pairs before counting, so a label on every line does not land in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstream.functions.common import explode_rows, let, quoted
from capstream.functions.logfields import (detect_level, mask_template, normalize_level, parse_fields,
                                           parse_quantity, pattern_regex)
from capstream.operators.ranking import exact_percentile
from capstream.operators.timeseries import bucket_of

# --- fixed values: names left out of discovery ---------------------------------------
INTERNAL_LABELS = ("__aggregated_metric__", "__stream_shard__")
LEVEL_FIELDS = ("level_extracted", "detected_level", "level")


# --- F1-F4: filters ----------------------------------------------------------------------

def line_filter(df: DataFrame, op: str, text: str, case_sensitive: bool = True, line: str = "line") -> DataFrame:
    """``|=`` contains, ``!=`` does not contain, ``|~`` regex matches, ``!~`` does not."""
    c = F.col(line)
    if op in ("|=", "!="):
        hit = c.contains(text) if case_sensitive else F.lower(c).contains(text.lower())
    elif op in ("|~", "!~"):
        hit = c.rlike(text if case_sensitive else "(?i)" + text)
    else:
        raise ValueError(f"unknown line filter {op!r}")
    return df.where(hit if op in ("|=", "|~") else ~hit)


def pattern_filter(df: DataFrame, include: list[str] = (), exclude: list[str] = (), line: str = "line") -> DataFrame:
    """keep lines matching any ``include`` pattern and none of the ``exclude`` ones."""
    c = F.col(line)
    if include:
        cond = None
        for p in include:
            m = c.rlike(pattern_regex(p))
            cond = m if cond is None else (cond | m)
        df = df.where(cond)
    for p in exclude:
        df = df.where(~c.rlike(pattern_regex(p)))
    return df


def label_filter(df: DataFrame, label: str, op: str, value: str, labels: str = "labels") -> DataFrame:
    """``=``, ``!=``, ``=~`` (anchored regex), ``!~`` on one label. A missing label is ``""``."""
    v = F.coalesce(F.col(labels)[label], F.lit(""))
    conds = {"=": lambda: v == value, "!=": lambda: v != value,
             "=~": lambda: v.rlike(f"^(?:{value})$"), "!~": lambda: ~v.rlike(f"^(?:{value})$")}
    if op not in conds:
        raise ValueError(f"unknown label matcher {op!r}")
    return df.where(conds[op]())


def field_value(fields: Column, name: str, kind: str | None = None, unit: str | None = None) -> Column:
    """A parsed field as a number: plain (``kind=None``), ``duration`` or ``bytes`` in ``unit``."""
    raw = fields[name]
    return raw.try_cast("double") if kind is None else parse_quantity(raw, kind, unit)


def field_filter(df: DataFrame, field: str, op: str, number: float, kind: str | None = None,
                 fields: str = "fields") -> DataFrame:
    """numeric comparison on a parsed field; lines where it is not a number drop out."""
    v = field_value(F.col(fields), field, kind)
    ops = {">": v > number, "<": v < number, ">=": v >= number, "<=": v <= number,
           "==": v == number, "!=": v != number}
    if op not in ops:
        raise ValueError(f"unknown comparison {op!r}")
    return df.where(ops[op])


def with_fields(df: DataFrame, fmt: str, line: str = "line", out: str = "fields") -> DataFrame:
    """add the parsed field map.

    The map comes out of a one-row generator so that a later filter on a field
    stays above the parse instead of parsing every line again in the scan.
    """
    keep = tuple(quoted(c) for c in df.columns if c != out)  # a new parse replaces an old one
    return explode_rows(df, F.array(parse_fields(F.col(line), fmt)), (out,), keep=keep)


def with_level(df: DataFrame, line: str = "line", fields: str | None = "fields", out: str = "detected_level"):
    return df.withColumn(out, detect_level(F.col(line), F.col(fields) if fields else None))


# --- F7-F11: counts and values over time ---------------------------------------------------

def _by_col(by: str | None, labels: str) -> list[Column]:
    if by is None:
        return []
    if by == "detected_level":
        return [F.col("detected_level")]
    return [F.col(labels)[by].alias(by)]


def log_volume(df: DataFrame, step_ms: int, by: str | None = None, ts: str = "ts",
               labels: str = "labels") -> DataFrame:
    """Lines per step, in total or per label value / ``detected_level``."""
    return (df.groupBy(bucket_of(df, ts, step_ms).alias("bucket_start"), *_by_col(by, labels))
            .agg(F.count(F.lit(1)).alias("count")))


def field_avg(df: DataFrame, field: str, step_ms: int, kind: str | None = None, ts: str = "ts",
              fields: str = "fields", unit: str | None = None) -> DataFrame:
    """average of a numeric field per step; lines where it does not parse are dropped."""
    v = field_value(F.col(fields), field, kind, unit)
    # avg skips NULLs (unparsable values); steps where nothing parsed are
    # dropped after the aggregate (a filter before it would be pushed into the
    # scan and evaluate the parse a second time)
    return (df.select(bucket_of(df, ts, step_ms).alias("bucket_start"), v.alias("_v"))
            .groupBy("bucket_start").agg(F.avg("_v").alias("avg")).where(F.col("avg").isNotNull()))


def field_breakdown(df: DataFrame, field: str, step_ms: int, ts: str = "ts", fields: str = "fields") -> DataFrame:
    """lines per step per value of a (non-numeric) field."""
    v = F.col(fields)[field]
    return (df.where(v.isNotNull()).groupBy(bucket_of(df, ts, step_ms).alias("bucket_start"), v.alias(field))
            .agg(F.count(F.lit(1)).alias("count")))


def rollup_volume(counts: DataFrame, step_ms: int, by: str = "detected_level", ts: str = "bucket_start",
                  count: str = "count") -> DataFrame:
    """sum a pre-aggregated count column to a coarser step."""
    return (counts.groupBy(bucket_of(counts, ts, step_ms).alias("bucket_start"), by)
            .agg(F.sum(count).alias(count)))


# --- F12-F16: label and field discovery -----------------------------------------------------

def top_volume(df: DataFrame, label: str, limit: int | None = None, unit: str = "bytes",
               labels: str = "labels", line: str = "line") -> DataFrame:
    """volume per value of a label, largest first, at most ``limit`` values (all by default).

    Volume is UTF-8 bytes of the lines (``unit='rows'`` counts lines).
    """
    v = F.octet_length(line).cast("bigint") if unit == "bytes" else F.lit(1).cast("bigint")
    agg = (df.where(F.col(labels)[label].isNotNull())
           .groupBy(F.col(labels)[label].alias(label)).agg(F.sum(v).alias("volume")))
    out = agg.orderBy(F.col("volume").desc(), F.col(label))
    return out if limit is None else out.limit(limit)


def _pairs(df: DataFrame, labels: str) -> DataFrame:
    return explode_rows(df, F.col(labels), ("name", "value"))


def detected_labels(df: DataFrame, labels: str = "labels", approx: bool = False) -> DataFrame:
    """label names with their number of distinct values, internal names left out.

    Sorted by cardinality ascending with single-valued labels last.
    """
    p = _pairs(df, labels).where(~F.col("name").isin(*INTERNAL_LABELS))
    card = F.approx_count_distinct("value").cast("bigint") if approx else F.count_distinct("value")
    agg = p.groupBy("name").agg(card.alias("cardinality"))  # distinct non-NULL values
    return agg.select(F.col("name").alias("label"), "cardinality").orderBy(
        (F.col("cardinality") == 1).asc(), F.col("cardinality").asc(), F.col("label").asc())


def _value_type(v: Column) -> Column:
    """Type vote of one value: int, float, duration, bytes, boolean, string."""
    def body(s: Column) -> Column:
        return (F.when(s.rlike("^-?[0-9]+$"), "int")
                .when(s.try_cast("double").isNotNull() & s.rlike("^-?[0-9.eE+-]+$"), "float")
                .when(parse_quantity(s, "duration").isNotNull(), "duration")
                .when(parse_quantity(s, "bytes").isNotNull(), "bytes")
                .when(F.lower(s).isin("true", "false"), "boolean")
                .otherwise("string"))
    return let(F.trim(v), body)


def detected_fields(df: DataFrame, parsers: tuple[str, ...] = ("json", "logfmt"), line: str = "line",
                    approx: bool = False, metadata: str | None = None) -> DataFrame:
    """fields found by the parsers: name, cardinality, parsers that found it, type.

    Each line is parsed by the parser that fits it (json for objects, logfmt
    otherwise, among ``parsers``); ``metadata`` names a map column whose members
    are fields too, reported as ``structuredMetadata`` where no parser finds
    them. The type is the widest vote over values (int < float < string;
    duration/bytes/boolean only when unanimous).
    """
    use_json, use_logfmt = "json" in parsers, "logfmt" in parsers

    def entries(fields: Column, parser: str | None) -> Column:
        return F.transform(F.map_entries(fields), lambda e: F.struct(
            e["key"].alias("name"), e["value"].alias("value"), F.lit(parser).cast("string").alias("parser")))

    def body(t: Column) -> Column:
        obj = F.trim(t).startswith("{")
        return (F.when(obj & F.lit(use_json), entries(parse_fields(t, "json"), "json"))
                .when(~obj & F.lit(use_logfmt), entries(parse_fields(t, "logfmt"), "logfmt")))

    none = F.array().cast("array<struct<name:string,value:string,parser:string>>")
    found = F.coalesce(let(F.col(line), body), none)
    if metadata:
        found = F.concat(found, F.coalesce(entries(F.col(metadata), None), none))
    # explode (not a filter) drops lines no parser takes, so nothing is pushed into the scan
    pairs = (explode_rows(df, found, ("_e",)).select("_e.name", "_e.value", "_e.parser")
             .where(~F.col("name").isin(*LEVEL_FIELDS, *INTERNAL_LABELS)))
    # one row per (name, value, parser) first: bounded by distinct values, not lines
    dv = pairs.distinct()
    typed = dv.select("name", "value", "parser", _value_type(F.col("value")).alias("t"))
    card = F.approx_count_distinct("value").cast("bigint") if approx else F.count_distinct("value")
    agg = typed.groupBy("name").agg(
        card.alias("cardinality"),
        F.array_join(F.array_sort(F.collect_set("parser")), ",").alias("parsers"),
        F.collect_set("t").alias("_types"))
    ts = F.col("_types")
    typ = (F.when(F.size(ts) == 1, ts[0])
           .when(F.forall(ts, lambda x: x.isin("int", "float")), "float")
           .otherwise("string"))
    return agg.select("name", "cardinality",
                      F.when(F.col("parsers") == "", "structuredMetadata").otherwise(F.col("parsers")).alias("parsers"),
                      typ.alias("type"))


def column_stats(df: DataFrame, labels: str = "labels") -> DataFrame:
    """per label: percent of lines carrying it (rounded up), distinct values, longest value.

    Every line adds one marker pair without a name, so the number of lines comes
    out of the same aggregate as the labels' counts (one scan).
    """
    pair = "struct<name:string,value:string>"
    own = F.transform(F.map_entries(F.col(labels)), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
    marked = F.concat(F.coalesce(own, F.array().cast(f"array<{pair}>")),
                      F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("value"))))
    per = (df.select(F.explode(marked).alias("p")).select("p.name", "p.value")
           .groupBy("name").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("value").alias("cardinality"),
                                F.max(F.length("value")).cast("bigint").alias("max_length")))
    total = F.max(F.when(F.col("name").isNull(), F.col("_n"))).over(Window.partitionBy())  # one row per label name
    return (per.withColumn("_all", total).where(F.col("name").isNotNull())
            .select(F.col("name").alias("label"),
                    F.ceil(F.col("_n") * 100 / F.col("_all")).cast("bigint").alias("percent_of_lines"),
                    "cardinality", "max_length"))


def label_sparsity(df: DataFrame, label: str, labels: str = "labels") -> DataFrame:
    """F16: percent of lines that carry ``label``."""
    has = F.col(labels)[label].isNotNull().cast("double")
    return df.agg((F.avg(has) * 100).alias("percent")).select(F.lit(label).alias("label"), "percent")


# --- F17-F19 -----------------------------------------------------------------------------------

def log_patterns(df: DataFrame, step_ms: int, recent_ms: int | None = None, ts: str = "ts",
                 line: str = "line", sort: bool = True) -> DataFrame:
    """line templates with their count per step and overall total.

    ``recent_ms`` keeps only lines within that span of the newest line (a scalar
    subquery, no join; all lines by default). Sorted by ``total`` descending (most
    frequent pattern first) unless ``sort=False`` (callers that aggregate further).
    """
    if recent_ms is not None:
        newest = df.select(F.max(ts)).scalar()
        df = df.where(F.col(ts) >= F.timestamp_add("MILLISECOND", F.lit(-int(recent_ms)), newest))
    per_step = (df.groupBy(mask_template(F.col(line)).alias("pattern"), bucket_of(df, ts, step_ms).alias("bucket_start"))
                .agg(F.count(F.lit(1)).alias("count")))
    # one row per (pattern, step): the window holds a pattern's steps, not its lines
    out = per_step.withColumn("total", F.sum("count").over(Window.partitionBy("pattern")))
    return out.orderBy(F.col("total").desc(), F.col("pattern"), F.col("bucket_start")) if sort else out


RANK_STATS = ("stddev", "sum", "max", "min", "p10", "p25", "p75", "p90", "p99", "name")
SKETCH_ACCURACY = 10_000


def rank_series(df: DataFrame, series: str, value: str, by: str = "stddev", desc: bool = True,
                exact: bool = True) -> DataFrame:
    """one score per series, sorted (descending by default).

    stddev is the population form. Percentiles are exact with linear
    interpolation (``exact_percentile``, skew-safe); ``exact=False`` uses the
    mergeable sketch alone. ``by='name'`` sorts by the series name. An unknown
    ``by`` falls back to stddev.
    """
    if by not in RANK_STATS:
        by = "stddev"
    v = F.col(value)
    order = F.col("score").desc() if desc else F.col("score").asc()
    if by == "name":
        out = df.select(series).distinct().withColumn("score", F.lit(None).cast("double"))
        return out.orderBy(F.col(series).desc() if desc else F.col(series).asc())
    if by.startswith("p"):
        q = int(by[1:]) / 100.0
        if exact:
            out = exact_percentile(df, (series,), value, q)
        else:
            out = df.groupBy(series).agg(F.percentile_approx(v, q, SKETCH_ACCURACY).cast("double").alias("score"))
        return out.orderBy(order, F.col(series).asc())
    stat = {"stddev": F.stddev_pop, "sum": F.sum, "max": F.max, "min": F.min}[by](v)
    return df.groupBy(series).agg(stat.alias("score")).orderBy(order, F.col(series).asc())


def level_counts(df: DataFrame, level_col: str = "level") -> DataFrame:
    """F19 applied: lines per normalised level."""
    return df.groupBy(normalize_level(F.col(level_col)).alias("level")).agg(F.count(F.lit(1)).alias("count"))
