"""E9 on documents parsed once: a VARIANT column, with hot paths as typed columns.

``json_at`` reads the text again for every path. Here a document is parsed once
(``parsed``; the parse stands behind a one-row generator, so no filter or second
use repeats it), every path is a walk in the parsed value (``variant_at``), and
paths that are asked all the time are columns of their own in the written table
(``write_documents``): a read of those alone never touches the documents.

The answers are those of ``json_at``, with two differences that a parsed value
brings: keys come in sorted order, and numbers in their shortest form. Text that
is not JSON, and NULL, have NULL at every path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.common import explode_rows, quoted
from capstream.operators.serving import _path


def parsed(df: DataFrame, text_col: str, out: str = "doc") -> DataFrame:
    """``df`` with the parsed document in ``out`` instead of the text."""
    keep = tuple(c for c in df.columns if c != text_col)
    return explode_rows(df, F.array(F.try_parse_json(quoted(text_col))), (out,), keep=tuple(map(quoted, keep)))


def variant_at(doc: Column | str, path: str, op: str = "get") -> Column:
    """``get`` (text; strings unquoted, the rest as JSON), ``type``, ``objkeys`` (array), ``objlen``, ``arrlen`` at a path."""
    v, p = F.col(doc) if isinstance(doc, str) else doc, _path(path)
    if op == "get":
        return F.try_variant_get(v, p, "string")
    if op == "type":
        t = F.schema_of_variant(F.try_variant_get(v, p, "variant"))
        return (F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array").when(t == "STRING", "string").when(t == "BOOLEAN", "boolean")
                .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
                .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "number").when(t == "VOID", "null"))
    if op in ("objkeys", "objlen"):
        keys = F.map_keys(F.try_variant_get(v, p, "map<string,variant>"))
        return keys if op == "objkeys" else F.when(keys.isNotNull(), F.size(keys)).cast("bigint")
    if op == "arrlen":
        items = F.try_variant_get(v, p, "array<variant>")
        return F.when(items.isNotNull(), F.size(items)).cast("bigint")
    raise ValueError(f"unknown json op {op!r}")


def write_documents(df: DataFrame, path: str, text_col: str, hot: dict[str, tuple[str, str]]) -> None:
    """Write ``df`` with its documents parsed and the ``hot`` paths (name -> (path, type)) as columns.

    A value that does not fit the type is NULL in its column; the document keeps it.
    """
    docs = parsed(df, text_col)
    docs.select("*", *[F.try_variant_get("doc", _path(p), kind).alias(name) for name, (p, kind) in hot.items()]).write.parquet(path)


class Documents:
    """A written table of documents; paths are read from their column if they have one."""

    def __init__(self, spark: SparkSession, path: str, hot: dict[str, tuple[str, str]]):
        self.df = spark.read.parquet(path)
        self.hot = {(_path(p), kind): name for name, (p, kind) in hot.items()}

    def value(self, path: str, kind: str = "string") -> Column:
        """The value at a path, of a type."""
        name = self.hot.get((_path(path), kind))
        return quoted(name) if name else F.try_variant_get("doc", _path(path), kind)
