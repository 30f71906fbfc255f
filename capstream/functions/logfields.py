"""Column functions for log lines: field parsing, quantities, levels, patterns.

All built from Spark SQL expressions (regexes, maps, higher-order functions) on
the JVM, with no Python per row; lambda bodies are interpreted, not generated code.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from capstream.functions.common import let

# --- fixed values: quantity units, in whole base units ---------------------------------
# durations in nanoseconds
DURATION_UNITS = {"ns": 1.0, "us": 1e3, "µs": 1e3, "ms": 1e6, "s": 1e9, "m": 60e9, "h": 3600e9}
# sizes in bytes: decimal multiples for KB.., binary for KiB..
BYTE_UNITS = {"B": 1.0, "KB": 1e3, "MB": 1e6, "GB": 1e9, "TB": 1e12,
              "KiB": 1024.0, "MiB": 1024.0 ** 2, "GiB": 1024.0 ** 3, "TiB": 1024.0 ** 4}
DEFAULT_UNIT = {"duration": "s", "bytes": "B"}

# --- fixed values: level classes (case-insensitive, whole value) -------------------------
LEVEL_CLASSES = (
    ("info", "^info$"),
    ("debug", "^debug$"),
    ("warn", "^(warn|warning)$"),
    ("error", "^error$"),
    ("critical", "^(crit|critical|fatal)$"),
    ("logs", "^(logs|unknown)$"),
)
DEFAULT_LEVEL = "logs"
LEVEL_WORD = r"(?i)\b(info|debug|warn|warning|error|crit|critical|fatal)\b"


def _unit_map(units: dict[str, float]) -> Column:
    args = []
    for k, v in units.items():
        args += [F.lit(k), F.lit(v)]
    return F.create_map(*args)


def _alternation(units: dict[str, float]) -> str:
    # longest first so "ms" wins over "m", "KiB" over "KB"
    return "|".join(re.escape(u) for u in sorted(units, key=len, reverse=True))


def parse_quantity(c: Column | str, kind: str, unit: str | None = None) -> Column:
    """``"1h30m"``, ``"12ms"`` -> seconds; ``"3KB"``, ``"2 MiB"`` -> bytes; a bare number
    is taken as already in ``unit``; anything else is NULL.

    ``unit`` picks the output unit (default seconds / bytes). Parts are summed
    in whole base units (ns, bytes) and divided once, so integral inputs give
    exact results in ``ns``.
    """
    c = F.col(c) if isinstance(c, str) else c
    units = {"duration": DURATION_UNITS, "bytes": BYTE_UNITS}[kind]
    scale = units[unit or DEFAULT_UNIT[kind]]
    alt = _alternation(units)
    part = f"([0-9]+(?:\\.[0-9]+)?)\\s*({alt})"
    umap = _unit_map(units)

    sign_ok = "[+-]?" if kind == "duration" else ""  # durations may be signed ("-1.5h")

    def body(s: Column) -> Column:
        whole = s.rlike(f"^{sign_ok}({part})+$")
        parts = F.regexp_extract_all(s, F.lit(part), 0)
        total = F.aggregate(
            parts, F.lit(0.0),
            lambda acc, x: acc + F.regexp_extract(x, "^([0-9.]+)", 1).cast("double")
            * F.element_at(umap, F.regexp_extract(x, f"({alt})$", 1)))
        signed = F.when(s.startswith("-"), -total).otherwise(total)
        return (F.when(whole, signed / F.lit(scale))
                .when(s.rlike(f"^{sign_ok}[0-9]+(\\.[0-9]+)?$"), s.cast("double")))
    return let(F.trim(c), body)


LOGFMT_PAIR = r'(?s)[A-Za-z_][A-Za-z0-9_.\-]*=(?:"(?:[^"\\]|\\.)*"|\S*)'


def logfmt_map(line: Column | str) -> Column:
    """``k=v k2="quoted value"`` -> map; quotes removed, ``\\"`` unescaped; first key wins.

    One regex pass finds the pairs; each is then cut at its first ``=``.
    """
    line = F.col(line) if isinstance(line, str) else line

    def pair(m: Column) -> Column:
        key = F.substring_index(m, "=", 1)
        raw = F.substring(m, F.length(key) + 2, F.length(m))
        bare = F.when(raw.startswith('"') & raw.endswith('"') & (F.length(raw) > 1),
                      F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
        return F.struct(key.alias("key"), F.replace(bare, F.lit('\\"'), F.lit('"')).alias("value"))

    def first_wins(pairs: Column) -> Column:
        return let(F.transform(pairs, lambda e: e["key"]), lambda keys: F.map_from_entries(
            F.filter(pairs, lambda e, i: F.array_position(keys, e["key"]) == i + 1)))
    return let(F.transform(F.regexp_extract_all(line, F.lit(LOGFMT_PAIR), 0), pair), first_wins)


def json_map(line: Column | str) -> Column:
    """Top-level members of a JSON object as text (nested values as JSON text); NULL if not an object."""
    line = F.col(line) if isinstance(line, str) else line
    return let(line, lambda t: F.when(F.trim(t).startswith("{"), F.from_json(t, "map<string,string>")))


def parse_fields(line: Column | str, fmt: str) -> Column:
    """``json``, ``logfmt`` or ``mixed`` (json when the line is an object, else logfmt).

    A line that does not parse gives an empty map: the line is kept, the
    error is dropped.
    """
    empty = F.create_map().cast("map<string,string>")
    line = F.col(line) if isinstance(line, str) else line
    if fmt == "json":
        return F.coalesce(json_map(line), empty)
    if fmt == "logfmt":
        return F.coalesce(logfmt_map(line), empty)
    if fmt == "mixed":
        return let(line, lambda t: F.coalesce(json_map(t), logfmt_map(t), empty))
    raise ValueError("fmt must be json, logfmt or mixed")


def normalize_level(c: Column | str) -> Column:
    """raw level text -> info, debug, warn, error, critical or logs."""
    c = F.col(c) if isinstance(c, str) else c

    def body(s: Column) -> Column:
        out = None
        for name, rx in LEVEL_CLASSES:
            cond = s.rlike("(?i)" + rx)
            out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
        return out.otherwise(F.lit(DEFAULT_LEVEL))
    return let(F.trim(c), body)


def detect_level(line: Column | str, fields: Column | None = None) -> Column:
    """Level from a parsed ``level`` field, else the first level word in the line."""
    line = F.col(line) if isinstance(line, str) else line
    word = F.nullif(F.regexp_extract(line, LEVEL_WORD, 1), F.lit(""))
    raw = F.coalesce(fields["level"], word) if fields is not None else word
    return normalize_level(raw)


# --- patterns -----------------------------------------------------------------------

def pattern_regex(pattern: str) -> str:
    """``<_>`` (or ``<name>``) matches any text; everything else literally; whole line."""
    parts = re.split(r"<[A-Za-z_][A-Za-z0-9_]*>", pattern)
    return r"(?s)\A" + "(.*?)".join(re.escape(p) for p in parts) + r"\z"


# --- fixed values: what the pattern miner masks, in order ------------------------------
MASKS = (
    r'([:=])"(?:[^"\\]|\\.)*"',                                       # quoted values (keys stay)
    r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",  # uuid
    r"\b\d{1,3}(?:\.\d{1,3}){3}\b",                                   # ipv4
    r"\b0x[0-9a-fA-F]+\b",                                            # hex
    r"-?\d+(?:\.\d+)?(?:[a-zA-Zµ]+)?",                                # numbers, with units
)
PLACEHOLDER = "<_>"


def mask_template(line: Column | str) -> Column:
    """F17 (our definition): the line with variable tokens replaced by ``<_>``."""
    c = F.col(line) if isinstance(line, str) else line
    for rx in MASKS:
        c = F.regexp_replace(c, rx, ("$1" if rx.startswith("([:=])") else "") + PLACEHOLDER)
    return F.regexp_replace(c, "(<_>)(\\s*<_>)+", PLACEHOLDER)
