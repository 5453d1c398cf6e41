"""Quality rules as a ledger of bits.

Each rule is a bound on one measurement. A document is measured once, every rule is tried
once, and the ledger keeps the measurements and a mask of failed rules. Policies are
versioned sets of rules: a policy's verdict and what a rule alone removes are bitwise
operations on the mask, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import BLANKS, slices, texts_of, words

#: Symbols that mark junk in running text.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Fails where the condition holds; its bit never changes once given."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "many_repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 3 * n_words"),
    Rule(3, "long_words", "word_chars > 14 * n_words"),
    Rule(4, "many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule(5, "many_repeated_lines", "2 * n_dup_lines > n_text_lines"),
    Rule(6, "very_few_words", "n_words < 5"),
    Rule(7, "very_many_symbols", "n_symbols > n_words"),
)
#: Policy versions: names of rules, each of which rejects.
POLICIES: Mapping[str, Sequence[str]] = {
    "base-1": ("few_words", "many_repeated_words"),
    "standard-1": (
        "few_words",
        "many_repeated_words",
        "short_words",
        "long_words",
        "many_symbols",
        "many_repeated_lines",
    ),
    "lenient-1": ("many_repeated_words", "very_few_words", "very_many_symbols"),
}


def measured(text: str) -> tuple[int, int, int, int, int, int]:
    """The measurements of one text, then its lines that hold a word."""
    found = words(text)
    n = len(found)
    chars = sum(len(w.decode("utf-8", "surrogatepass")) for w in found)
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = repeated = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            lines += 1
            repeated += line in seen
            seen.add(line)
    return n, chars, symbols, repeated, _words_in_repeats(found), lines


def _words_in_repeats(found: list[bytes], width: int = 3) -> int:
    """Words in windows that stand twice or more in the text, the first time included."""
    windows = list(zip(*(found[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count: dict[tuple, int] = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered, until = 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered += i + width - max(i, until)
            until = i + width
    return covered


def ledger(df: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of df: the key, the measurements (MEASURES and `n_text_lines`)
    and `failed`, a long with the bits of all rules that fail.

    Null and empty texts measure zero. A null key stays null; repeated rows each give a
    row; other columns are not read. Every row is measured in the scan, without a shuffle.
    """
    names = [*MEASURES, "n_text_lines"]

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [measured(t) for t in texts_of(batch)]
            columns = [pa.array(c, type=pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    chosen = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    measures = chosen.mapInArrow(blocks, ", ".join([f"`{key}` {kind}", *[f"{n} long" for n in names]]))
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measures.withColumn("failed", failed)


def mask(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bits of a policy's rules."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << {r.name: r.bit for r in rules}[n] for n in names)


def passes(policy: str | Sequence[str], failed: str = "failed") -> Column:
    """Whether no rule of the policy fails."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def ablations(kept: DataFrame, policy: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each rule of a policy: `n_failed` rows that fail it, and `n_only` rows that the
    policy without it would keep. One row a rule, one pass over the ledger's masks."""
    whole = mask(policy, rules)
    mine = F.col("failed").bitwiseAND(F.lit(whole))
    by_mask = kept.groupBy(mine.alias("failed")).agg(F.count("*").alias("n"))
    rows = [(r.bit, r.name) for r in rules if whole >> r.bit & 1]
    picked = F.explode(F.array(*[F.struct(F.lit(1 << b).cast("long").alias("bit"), F.lit(n).alias("rule")) for b, n in rows]))
    spread = by_mask.select("failed", "n", picked.alias("r"))
    hit = F.when(F.col("failed").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)
    alone = F.when(F.col("failed") == F.col("r.bit"), F.col("n")).otherwise(0)
    return spread.groupBy(F.col("r.rule").alias("rule")).agg(F.sum(hit).alias("n_failed"), F.sum(alone).alias("n_only"))


def verdicts(kept: DataFrame, policy: str = "standard-1", key: str = "doc_id") -> DataFrame:
    """The measurements, the base policy's verdict and the chosen policy's."""
    base = ~passes("base-1")
    return kept.select(key, *MEASURES, base.alias("base_failed"), (~base & passes(policy)).alias("kept"), "failed")


ORACLE = r"""
with w as (
  select doc_id, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from {documents}
), lines as (
  select doc_id, line, count(*) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from w)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by all
), l as (
  select doc_id, sum(n - 1) as n_dup_lines, sum(n) as n_text_lines from lines group by doc_id
), grams as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from
    (select doc_id, i, [w[i], w[i + 1], w[i + 2]] as g from w, unnest(range(1, len(w) - 1)) u(i))
), r as (
  select doc_id, count(distinct i + j) as n_repeat_words from grams, (values (0), (1), (2)) v(j) where n > 1 group by doc_id
), m as (
  select w.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, cast(coalesce(n_text_lines, 0) as bigint) as n_text_lines
  from w left join l on l.doc_id = w.doc_id left join r on r.doc_id = w.doc_id
), b as (
  select *, cast((n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (word_chars < 3 * n_words)::int
    + 8 * (word_chars > 14 * n_words)::int + 16 * (10 * n_symbols > 3 * n_words)::int
    + 32 * (2 * n_dup_lines > n_text_lines)::int + 64 * (n_words < 5)::int + 128 * (n_symbols > n_words)::int as bigint) as failed from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 as base_failed, failed & 63 = 0 as kept, failed from b
"""
