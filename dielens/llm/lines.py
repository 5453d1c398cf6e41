"""Dropping lines that many documents share, in DataFrame operations alone.

Normalised lines are exploded and hashed, distinct documents are counted for each hash,
and the places of lines over the threshold go back to their documents, where the other
lines are joined again by position. Line texts are never shuffled: only hashes, row keys
and positions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import ascii_lower, text_or_empty

#: What stands for nothing at a line's ends.
BLANK_CHARACTERS = " \t\n\v\f\r"
#: Parts that the places of a line are dealt to.
SALTS = 32


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANK_CHARACTERS))
    plain = F.octet_length(bare) == F.char_length(bare)  # of ASCII alone, where `lower` changes A-Z only
    return F.when(plain, F.lower(bare)).otherwise(ascii_lower(bare))


def _lines(text: str) -> Column:
    return F.split(text_or_empty(text), "\n", -1)


def _hashes(lines: Column, shortest: int) -> Column:
    """For each line two 64-bit hashes of its key, null for keys that are too short."""
    # a line too short has a key too short
    key = F.transform(lines, lambda x: F.when(F.char_length(x) >= shortest, line_key(x)))
    pair = lambda k: F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit("line"), k).alias("b"))
    return F.transform(key, lambda k: F.when(F.char_length(k) >= shortest, pair(k)))


def drop_shared_lines(df: DataFrame, at_least: int = 3, shortest: int = 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of df with the text deduplicated, and `n_lines`, `n_dropped`.

    A key of `shortest` code points or more that stands in `at_least` documents keeps its
    lines only in the document with the largest key holding it. Null or empty texts are
    one empty line and come back as empty texts. Rows that repeat a doc_id count as one
    document for the threshold; exact repeats give equal rows. Rows without a doc_id do not
    count for the threshold and keep no shared line. The added columns replace columns of
    those names; columns whose names begin with two underscores are not carried.
    """
    row = F.xxhash64(F.col(text))
    hashed = df.select(F.col(key).alias("doc"), row.alias("row"), _hashes(_lines(text), shortest).alias("hash"))
    placed = (
        hashed.select("doc", "row", F.posexplode("hash").alias("place", "hash"))
        .where("hash is not null")
        .select("doc", "row", "place", "hash.a", "hash.b", F.pmod(F.xxhash64("doc", "row"), F.lit(SALTS)).cast("int").alias("salt"))
    )
    # a hot line is combined before its shuffle; its places meet it in as many parts as hold one
    shared = (
        placed.groupBy("a", "b")
        .agg(
            F.count_distinct("doc").alias("n"), F.max("doc").alias("last"),
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))).alias("salts"),
        )
        .where(F.col("n") >= at_least)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        .where(F.getbit("salts", F.col("salt")) == 1)
        .select("a", "b", "salt", "last")
    )
    gone = (
        placed.join(shared, ["a", "b", "salt"])
        .where(~F.col("doc").eqNullSafe(F.col("last")))
        .groupBy("doc", "row")
        .agg(F.collect_set("place").alias("gone"))
    )
    mine = df.drop("n_lines", "n_dropped").withColumns({"__row": row, "__lines": _lines(text)})
    joined = mine.join(gone, mine[key].eqNullSafe(gone["doc"]) & (mine["__row"] == gone["row"]), "left")
    lines = mine["__lines"]
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["gone"])
    kept = F.when(gone["gone"].isNull(), text_or_empty(text)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    )
    return joined.select(
        *[kept.alias(c) if c == text else mine[c] for c in mine.columns if not c.startswith("__")],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone["gone"]), F.lit(0)).cast("long").alias("n_dropped"),
    )


def digest(deduplicated: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return deduplicated.select(
        key, "n_lines", "n_dropped", F.sha2(F.col(text).cast("binary"), 256).alias("kept_sha256")
    )


ORACLE = r"""
with l as (
  select doc_id, i - 1 as place, lines[i] as line,
    translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from {documents}) d, unnest(range(1, len(lines) + 1)) u(i)
), s as (
  select k, max(doc_id) as last from l where length(k) >= 20 group by k having count(distinct doc_id) >= 3
), f as (
  select l.*, s.k is not null and l.doc_id <> s.last as gone from l left join s on l.k = s.k
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from f group by doc_id
"""
