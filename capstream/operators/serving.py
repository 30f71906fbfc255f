"""key/value style reads expressed as DataFrame operators.

Inputs are ordinary DataFrames: hashes are ``(hash_key, fields map)``, sets
are ``(key, member)``, sorted sets ``(key, member, score)``, streams and
series ``(key, ts, value...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.operators.ranking import rank_within


# --- E4 ---------------------------------------------------------------------

def latest_per_key(df: DataFrame, keys: tuple[str, ...], ts: str, value: str,
                   tiebreak: str | None = None) -> DataFrame:
    """Newest sample per key (``ts.get`` / ``ts.mget``); ties broken by ``tiebreak``."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return df.groupBy(*keys).agg(F.max(ts).alias(ts), F.max_by(value, order).alias(value))


# --- E5 ---------------------------------------------------------------------

def match_labels(df: DataFrame, labels_col: str = "labels", equals: dict | None = None,
                 not_equals: dict | None = None, any_of: dict | None = None, none_of: dict | None = None,
                 present: tuple[str, ...] = (), absent: tuple[str, ...] = ()) -> DataFrame:
    """E5: keep rows whose label map matches every condition (``label=value`` style filters)."""
    lab = F.col(labels_col)
    conds: list[Column] = []
    for k, v in (equals or {}).items():
        conds.append(lab[k] == F.lit(v))
    for k, v in (not_equals or {}).items():
        conds.append(lab[k].isNull() | (lab[k] != F.lit(v)))
    for k, vs in (any_of or {}).items():
        conds.append(lab[k].isin(list(vs)))
    for k, vs in (none_of or {}).items():
        conds.append(lab[k].isNull() | ~lab[k].isin(list(vs)))
    conds += [lab[k].isNotNull() for k in present]
    conds += [lab[k].isNull() for k in absent]
    for c in conds:
        df = df.where(c)
    return df


def list_series(df: DataFrame, series_col: str = "series") -> DataFrame:
    """E5: the distinct keys (``ts.queryindex``)."""
    return df.select(series_col).distinct()


# --- E6 ---------------------------------------------------------------------

def range_entries(df: DataFrame, ts: str, start=None, end=None, count: int | None = None,
                  reverse: bool = False, keys: tuple[str, ...] = (), tiebreak: str | None = None) -> DataFrame:
    """Entries with ``start <= ts <= end``, oldest first (newest first with ``reverse``),
    at most ``count`` of them (per key when ``keys`` are given; a key of any size, for any count)."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end))
    cols = [ts] + ([tiebreak] if tiebreak else [])
    order = [F.col(c).desc() if reverse else F.col(c).asc() for c in cols]
    if count is None:
        return df.orderBy(*keys, *order)
    if not keys:
        return df.orderBy(*order).limit(count)  # top-k per partition, then one merge
    return rank_within(df, keys, [(c, not reverse) for c in cols], out="_rank", first=count).drop("_rank")


# --- E7 ---------------------------------------------------------------------

def zrange(df: DataFrame, lo, hi, by: str = "index", key: str = "key", member: str = "member",
           score: str = "score", reverse: bool = False) -> DataFrame:
    """Members of each sorted set by zero-based rank (``by='index'``, negative
    counts from the end) or by inclusive score range (``by='score'``).

    Order is score then member. Ranks come from ``rank_within``: no set, however
    large, is ranked by one task, whatever the range.
    """
    if by == "score":
        out = df.where(F.col(score).between(F.lit(lo), F.lit(hi)))
        return out.select(key, member, score)
    if by != "index":
        raise ValueError("by must be 'index' or 'score'")
    order = [(score, not reverse), (member, not reverse)]
    if lo < 0 and hi < 0:  # ranks from the end, turned round with the set's size
        out = rank_within(df, key, [(c, not up) for c, up in order], out="_back", size="_n", first=-lo).where(F.col("_back") >= -hi - 1)
        return out.select(key, member, score, (F.col("_n") - 1 - F.col("_back")).alias("rank"))
    out = rank_within(df, key, order, size=None if lo >= 0 and hi >= 0 else "_n", first=hi + 1 if hi >= 0 else None)
    lo_i = F.lit(lo) if lo >= 0 else F.col("_n") + F.lit(lo)
    hi_i = F.lit(hi) if hi >= 0 else F.col("_n") + F.lit(hi)
    return out.where((F.col("rank") >= lo_i) & (F.col("rank") <= hi_i)).select(key, member, score, "rank")


# --- E8 ---------------------------------------------------------------------

def hash_get(hashes: DataFrame, field: str, key: str | None = None) -> DataFrame:
    """``hget``: one field of one hash (or of every hash when ``key`` is None)."""
    if key is not None:
        hashes = hashes.where(F.col("hash_key") == key)
    return hashes.select("hash_key", F.col("fields")[field].alias("value"))


def hash_mget(hashes: DataFrame, fields: list[str], key: str | None = None) -> DataFrame:
    if key is not None:
        hashes = hashes.where(F.col("hash_key") == key)
    return hashes.select("hash_key", *[F.col("fields")[f].alias(f) for f in fields])


def hash_getall(hashes: DataFrame, key: str | None = None) -> DataFrame:
    """``hgetall``: one row per (hash, field, value)."""
    if key is not None:
        hashes = hashes.where(F.col("hash_key") == key)
    return hashes.select("hash_key", F.explode("fields").alias("field", "value"))


def hash_keys(hashes: DataFrame, key: str | None = None) -> DataFrame:
    if key is not None:
        hashes = hashes.where(F.col("hash_key") == key)
    return hashes.select("hash_key", F.explode(F.map_keys("fields")).alias("field"))


def hash_len(hashes: DataFrame) -> DataFrame:
    return hashes.select("hash_key", F.size("fields").cast("bigint").alias("n_fields"))


def get_value(kv: DataFrame, key: str, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """``get`` on a ``(key, value)`` frame."""
    return kv.where(F.col(key_col) == key).select(value_col)


def set_members(sets: DataFrame, key: str | None = None, key_col: str = "key", member: str = "member") -> DataFrame:
    """``smembers``: distinct members (of one set, or of all)."""
    if key is not None:
        sets = sets.where(F.col(key_col) == key)
    return sets.select(key_col, member).distinct()


def set_card(sets: DataFrame, key_col: str = "key", member: str = "member") -> DataFrame:
    """``scard``: distinct non-NULL members per set (0 for a set of NULLs).

    Spark plans a single distinct count as a dedupe of (set, member) with a
    partial aggregate, then a count per set, so a huge set is counted by many
    tasks."""
    return sets.groupBy(key_col).agg(F.count_distinct(member).alias("n_members"))


def list_len(lists: DataFrame, key_col: str = "key") -> DataFrame:
    """``llen`` / ``xlen``: entries per list or stream."""
    return lists.groupBy(key_col).agg(F.count(F.lit(1)).alias("n_entries"))


# --- E9 ---------------------------------------------------------------------

def _path(path: str) -> str:
    """``$.a.b``, ``.a.b`` or ``a.b`` -> ``$.a.b``; ``$``/``.`` is the root."""
    p = path.strip()
    if p in ("", ".", "$"):
        return "$"
    if p.startswith("$"):
        return p
    return "$" + (p if p.startswith(".") or p.startswith("[") else "." + p)


def json_type_name(text: Column) -> Column:
    """JSON type of a JSON text: object, array, string, integer, number, boolean, null."""
    t = F.schema_of_variant(F.try_parse_json(text))
    return (F.when(text.isNull(), F.lit(None).cast("string"))
            .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
            .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
            .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | t.rlike("^DECIMAL\\(\\d+,0\\)$"), "integer")
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "number")
            .when(t == "VOID", "null"))


def json_at(c: Column | str, path: str, op: str = "get") -> Column:
    """``get`` (JSON text of the value; strings unquoted), ``type``, ``objkeys``
    (array), ``objlen``, ``arrlen`` at a path."""
    c = F.col(c) if isinstance(c, str) else c
    p = _path(path)
    sub = c if p == "$" else F.get_json_object(c, p)
    if op == "get":
        return sub
    if op == "type":
        # get_json_object unquotes strings, so re-read the raw value as variant
        raw = F.variant_get(F.try_parse_json(c), p, "variant") if p != "$" else F.try_parse_json(c)
        return json_type_name(F.to_json(raw))
    if op == "objkeys":
        return F.json_object_keys(sub)
    if op == "objlen":
        return F.size(F.json_object_keys(sub)).cast("bigint")
    if op == "arrlen":
        return F.json_array_length(sub).cast("bigint")
    raise ValueError(f"unknown json op {op!r}")


# --- E10 --------------------------------------------------------------------

def search(df: DataFrame, text_col: str, terms: list[str], sort_by: str | None = None, desc: bool = False,
           offset: int = 0, limit: int | None = None, fields: list[str] | None = None,
           id_col: str | None = None) -> DataFrame:
    """Rows whose text holds every term (case-insensitive, whole text),
    sorted, paged with ``offset``/``limit`` (all of them by default), projected to ``fields``.

    The sort is made total with ``id_col`` so pages are stable.
    """
    low = F.lower(F.col(text_col))
    for t in terms:
        df = df.where(low.contains(t.lower()))
    order = []
    if sort_by:
        order.append(F.col(sort_by).desc() if desc else F.col(sort_by).asc())
    if id_col:
        order.append(F.col(id_col).asc())
    if order:
        df = df.orderBy(*order)
    if offset:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*fields) if fields else df


# --- E15, E16 ---------------------------------------------------------------

def values_list(df: DataFrame, name: str = "value") -> DataFrame:
    """Every value of every column as text, one row each."""
    return df.select(F.explode(F.array(*[F.col(c).cast("string") for c in df.columns])).alias(name))


def run_sql(spark: SparkSession, text: str, args: dict | None = None, views: dict[str, DataFrame] | None = None):
    """SQL with named parameter markers (``:name``) bound from ``args``.

    ``views`` are frames the text names as ``{name}``; they are bound to this
    statement only, so callers that use the same names do not disturb each other.
    """
    return spark.sql(text, args=args or {}, **(views or {}))
