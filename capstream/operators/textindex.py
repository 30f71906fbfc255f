"""E10 / F1 by an index: posting lists of words in blocks, and a term directory.

Words are the lower-cased runs of letters and digits. The index holds, for each
word and each block of ``BLOCK`` consecutive ids, the sorted ids of the rows with
that word, as steps from the block's begin; Parquet stores them delta-coded. A
word's postings lie in one of ``buckets`` folders, sorted by word and block, so
that a search reads the folders and row groups of its words alone. A word in
every row is many blocks of bounded size, spread over files.

``search_text`` answers ``serving.search`` (any text as a term, anywhere in the row's
text) from the same index: the pieces of a term that are letters and digits lie
inside words, so the directory's words that hold a piece lead to all rows that
could match; the terms are then looked up in those rows' texts alone.

A conjunction intersects the lists block by block: blocks that lack one of the
words drop out before any list is looked at. The directory says in how many
rows and blocks a word stands.

NULL texts and NULL ids are not indexed; rows that share an id are one entry.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.functions.common import explode_rows, quoted

#: Ids of a block; 64 blocks of a folder are sorted in one task.
BLOCK, BLOCKS_PER_TASK = 1 << 15, 64
NOT_A_WORD = r"[^\p{L}\p{N}]+"
#: Writer options: sorted integers as differences.
DELTA = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"}
TABLES = {"postings": "term string, block bigint, n int, ids array<int>, bucket int", "terms": "term string, rows bigint, blocks bigint, bucket int"}


def words_of(text: Column) -> Column:
    """The different words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), NOT_A_WORD), lambda w: w != ""))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_text_index(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", buckets: int = 64, block: int = BLOCK) -> str:
    """Write the index of ``df`` under ``path`` (``postings`` and ``terms``) and return the path."""
    path = path.rstrip("/")
    own = quoted(id_col).cast("bigint")
    words = explode_rows(df.where(own.isNotNull()), words_of(quoted(text_col)), ("term",), keep=(own.alias("_id"),))
    lists = (words.groupBy("term", F.floor(F.col("_id") / block).alias("block"))
             .agg(F.sort_array(F.collect_set(F.pmod("_id", F.lit(block)).cast("int"))).alias("ids"))
             .select(_bucket(F.col("term"), buckets).alias("bucket"), "term", "block", F.size("ids").alias("n"), "ids"))
    (lists.repartition("bucket", F.floor(F.col("block") / BLOCKS_PER_TASK)).sortWithinPartitions("bucket", "term", "block")
     .write.options(**DELTA).partitionBy("bucket").parquet(f"{path}/postings"))
    postings = df.sparkSession.read.schema(TABLES["postings"]).parquet(f"{path}/postings")
    terms = postings.groupBy("bucket", "term").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("blocks"))
    (terms.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms"))
    df.sparkSession.createDataFrame([(buckets, block)], "buckets int, block int").write.parquet(f"{path}/layout")
    return path


class TextIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        layout = spark.read.parquet(f"{self.path}/layout").head()  # one row of settings
        self.buckets, self.block = layout["buckets"], layout["block"]

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}")

    def _of(self, table: str, terms: list[str]) -> DataFrame:
        """Rows of the asked words: their folders, then their row groups."""
        wanted = self.spark.range(1).select(F.array_distinct(F.array(*[_bucket(F.lit(t), self.buckets) for t in terms]))).head()[0]  # of the asked words
        return self._table(table).where(F.col("bucket").isin(wanted) & F.col("term").isin(terms))

    def directory(self, terms: list[str] | None = None) -> DataFrame:
        """``term, rows, blocks`` of the given words, or of all."""
        rows = self._table("terms") if terms is None else self._of("terms", _lower(terms))
        return rows.select("term", "rows", "blocks")

    def ids(self, terms: list[str], any_of: bool = False) -> DataFrame:
        """``id`` of the rows that hold every word (with ``any_of``: one of them at least), each once."""
        terms = _lower(terms)
        if not terms:
            raise ValueError("no words to search for")
        lists = F.collect_list("ids")
        blocks = self._of("postings", terms).groupBy("block").agg(F.count(F.lit(1)).alias("k"), lists.alias("lists"))
        if not any_of:
            blocks = blocks.where(F.col("k") == len(terms))
        shortest_first = F.array_sort("lists", lambda a, b: F.size(a) - F.size(b))
        merge = F.array_union if any_of else F.array_intersect
        found = F.aggregate(F.slice(shortest_first, 2, len(terms)), F.element_at(shortest_first, 1), merge)
        return blocks.select("block", F.explode(found).alias("_o")).select((F.col("block") * self.block + F.col("_o")).alias("id"))

    def search(self, df: DataFrame, terms: list[str], id_col: str = "doc_id", any_of: bool = False) -> DataFrame:
        """The rows of ``df`` with these words; only their ids come from the index, no text is scanned for words."""
        return df.join(self.ids(terms, any_of), quoted(id_col) == F.col("id"), "leftsemi")


    def candidates(self, pieces: list[str]) -> DataFrame:
        """``id`` of the rows in which every piece is part of a word."""
        told = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(pieces)])
        words = (self._table("terms").select("bucket", "term", F.explode(F.filter(told, lambda x: F.contains(F.col("term"), x["p"]))).alias("x"))
                 .select("bucket", "term", F.col("x.i").alias("i")))
        ids = self._table("postings").join(words, ["bucket", "term"]).select("i", "block", F.explode("ids").alias("_o")).distinct()
        return (ids.groupBy("block", "_o").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") == len(pieces))
                .select((F.col("block") * self.block + F.col("_o")).alias("id")))

    def search_text(self, df: DataFrame, terms: list[str], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        """The rows of ``df`` whose text holds every term, as ``serving.search`` finds them.

        A term without a letter or digit has no piece and is looked up in every
        text that the other terms leave.
        """
        low = [t.lower() for t in terms]
        pieces = list(dict.fromkeys(p for t in low for p in re.split(r"[\W_]+", t) if p))
        rows = df.join(self.candidates(pieces), quoted(id_col) == F.col("id"), "leftsemi") if pieces else df
        for t in low:  # pieces need not stand together, and rows that share an id are one entry
            rows = rows.where(F.lower(quoted(text_col)).contains(t))
        return rows


def _lower(terms: list[str]) -> list[str]:
    return list(dict.fromkeys(t.lower() for t in terms))


def scan_words(df: DataFrame, terms: list[str], text_col: str = "text", any_of: bool = False) -> DataFrame:
    """The same rows without an index: every text is cut into words."""
    asked = F.array(*[F.lit(t) for t in _lower(terms)])
    words = words_of(quoted(text_col))
    return df.where(F.arrays_overlap(words, asked) if any_of else F.size(F.array_except(asked, words)) == 0)
