"""Mixing sources to target weights, in DataFrame operations alone.

The words of each source are one sequence, cut into blocks of fixed length. The output is a
list of slots, dealt to shards; each slot draws a source with the chance of its quota, so a
shard's counts are multinomial. What a source draws beyond its quota goes to sources that
drew less, so every quota is met. The slots of a source are numbered through all shards, the
number goes through the source's pseudorandom permutation of its block indices, and the index
is joined to the block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import BLANKS, text_or_empty
from dielens.llm.order import PART, ranged, totals_before
from dielens.plans.hold import hold

BLOCK = 256
SHARD = 1024
#: Rounds of the permutation. A round swaps an index with its mirror in a point of the round,
#: or not, by a bit of the larger of the two, so it is its own inverse on any number of blocks.
ROUNDS = 24
SEED = 20261

#: The prime 2^31 - 1; products of two numbers below it fit into a long.
_P = 2147483647
_POINT = "(({key} % {p}) * 16807 + ({r} + 1) * {c} + {seed}) % {p}"
_BIT = "((({v}) % {p}) * 48271 + ({key} % {p}) * 69621 + ({r} + 1) * 742938285) % {p}"


def _squared(text: str) -> str:
    return f"(({text}) * ({text}) % {_P})"


def swap_point(key: str, r: str, m: str) -> str:
    """The round's point below m, as SQL; key and r are SQL texts."""
    high, low = (_squared(_POINT.format(key=key, r=r, c=c, seed=SEED, p=_P)) for c in (1566083941, 1203248318))
    return f"(({high} * 2147483648 + {low}) % {m})"


def swap_bit(v: str, key: str, r: str) -> str:
    return f"({_squared(_BIT.format(v=v, key=key, r=r, p=_P))} % 2048 >= 1024)"


def permuted(x: str, key: str, m: str, inverse: bool = False) -> Column:
    """Place of index x (a column, 0 to m - 1) in the permutation with the key."""
    rounds = f"sequence({ROUNDS - 1}, 0)" if inverse else f"sequence(0, {ROUNDS - 1})"
    points = f"transform({rounds}, r -> struct(cast(r as bigint) as r, {swap_point(key, 'cast(r as bigint)', m)} as k))"
    mirror = f"pmod(s.k - x, {m})"
    step = f"if({swap_bit(f'greatest(x, {mirror})', key, 's.r')}, {mirror}, x)"
    return F.expr(f"aggregate({points}, cast({x} as bigint), (x, s) -> {step})")


def draw(slot: Column) -> Column:
    """A number of 60 bits for a slot, the same in every run."""
    text = F.concat(F.lit(f"{SEED}:"), slot.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


@dataclass(frozen=True)
class Mix:
    """docs: a row for each input row, `doc`, `row` (a hash of its text), `uid`, `size`, its
    words' place `start` in its source, `source_size` and `target`. slots: `shard`, `slot`,
    `name` (the source's key), `block` and `words`, how many of the block it takes."""

    docs: DataFrame
    slots: DataFrame
    block: int


def mix(
    df: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block: int = BLOCK,
    shard: int = SHARD,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> Mix:
    """A mix of all rows of df with `share` times their words.

    Sources take the weights in turn, by code point, null last. A source has at most `most`
    times its own words; what is beyond goes to the others by weight until none is above.
    Every source takes its target, rounded to words, and no row is taken more than `most`
    times. Null, empty and blank texts have no words and are never taken. Rows with a null
    or a repeated key are rows like others; among equal rows of a source which one is taken
    is open, but the counts are the same in every run. An empty table gives an empty mix.
    Other columns are not read.
    """
    size = F.regexp_count(text_or_empty(text), F.lit(f"[^{BLANKS}]+")).cast("long")
    name = F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("z"))
    counted = hold(
        df.select(
            F.col(key).alias("doc"), name.alias("name"), F.xxhash64(F.col(text)).alias("row"),
            F.monotonically_increasing_id().alias("uid"), size.alias("size"),
        )
    )
    order = ("doc", "row", "uid")
    docs = ranged(counted, "name", *order)
    sources = _sources(docs, weights, share, most, block)
    named = sources.select("name", "source_size", "target")
    placed = totals_before(docs, ["name"], order, {"start": F.col("size")}, also=named)
    return Mix(placed.drop(PART), hold(_slots(sources, block, shard)), block)


def _sources(docs: DataFrame, weights: Sequence[int], share: float, most: int, block: int) -> DataFrame:
    """One row a source: target, quota in words and slots, and what its permutation needs."""
    sizes = ranged(docs.groupBy("name").agg(F.sum("size").alias("source_size")), "name")
    ranked = totals_before(sizes, [], ["name"], {"rank": F.lit(1).cast("long")})
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    held = hold(ranked.select(PART, "name", "rank", "source_size", turn.cast("long").alias("w")))
    level = _level(held, share, most)
    words = F.least(F.floor(F.col("target") + F.lit(0.5)), F.col("source_size") * most)
    b = F.lit(block).cast("long")
    full = held.withColumn("cap", F.col("source_size") * most).withColumn(
        "target", F.when(_above(level), F.col("cap").cast("double")).otherwise(F.lit(level[0] / level[1]) * F.col("w"))
    )
    full = full.withColumn("words", words).withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    full = full.withColumn("whole", F.expr("if(source_size > 0, words div source_size, 0L)"))
    full = full.withColumns({
        "rest": F.col("words") - F.col("whole") * F.col("source_size"),
        "last": F.col("source_size") - (F.col("blocks") - 1) * b,
        "short_at": F.when(F.col("blocks") > 0, permuted("blocks - 1", "(rank * 4 + whole)", "blocks", inverse=True)),
    })
    over = F.col("rest") - F.col("short_at") * b - F.col("last")  # words beyond the short block
    more = (
        F.when(F.col("rest") <= F.col("short_at") * b, F.ceil(F.col("rest") / b))
        .when(over <= 0, F.col("short_at") + 1)
        .otherwise(F.col("short_at") + 1 + F.ceil(over / b))
    )
    slots = F.when(F.col("blocks") > 0, F.col("whole") * F.col("blocks") + more).otherwise(0).cast("long")
    return hold(full.withColumn("n", slots).drop("cap", "w", "words"))


def _above(level: tuple[float, int]) -> Column:
    """Whether a source's weight at the level (words for a weight of one) is above its cap."""
    doubled, w = round(2 * level[0]), level[1]  # halves at most
    big = lambda c: c.cast("decimal(38,0)")
    return big(F.col("cap") * 2) * big(F.lit(w)) < big(F.lit(doubled)) * big(F.col("w"))


def _level(sources: DataFrame, share: float, most: int) -> tuple[float, int]:
    """(words, weight) left for the sources below their caps; rises until none is above."""
    capped = sources.withColumn("cap", F.col("source_size") * most)
    total, weight = capped.agg(F.sum("source_size"), F.sum("w")).first()
    level, before = (share * (total or 0), weight or 1), None
    while level != before:
        before = level
        taken, theirs = capped.where(_above(level)).agg(F.sum("cap"), F.sum("w")).first()
        level = (share * (total or 0) - (taken or 0), (weight or 1) - (theirs or 0))
    return level


def _intervals(sources: DataFrame, low: str, n: str, *columns: str) -> DataFrame:
    """Each source once for every cell of SHARD numbers that its interval [low, low + n) meets."""
    cells = F.expr(f"explode(sequence({low} div {SHARD}, ({low} + {n} - 1) div {SHARD}))")
    return sources.where(F.col(n) > 0).select("name", F.col(low).alias("low"), F.col(n).alias("wide"), *columns, cells.alias("cell"))


def _within(numbers: DataFrame, number: str, intervals: DataFrame) -> DataFrame:
    """The numbers with the one interval each lies in, met by cell."""
    met = numbers.withColumn("cell", F.expr(f"{number} div {SHARD}")).join(intervals, "cell")
    return met.where((F.col(number) >= F.col("low")) & (F.col(number) < F.col("low") + F.col("wide"))).drop("cell", "wide")


def _slots(sources: DataFrame, block: int, shard: int) -> DataFrame:
    spark = sources.sparkSession
    quotas = hold(totals_before(sources, [], ["name"], {"low": F.col("n")}))
    n_slots = quotas.agg(F.sum("n")).first()[0] or 0
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.expr(f"id div {shard}").alias("shard"), (draw(F.col("id")) % max(n_slots, 1)).alias("drawn")
    )
    drawn = hold(_within(slots, "drawn", _intervals(quotas, "low", "n")).select("shard", "slot", "name"))
    # the multinomial counts: draws of a source in a shard, and those in the shards before
    counts = drawn.groupBy("shard", "name").agg(F.count("*").alias("draws"))
    counts = hold(counts.withColumn(PART, F.expr(f"shard div {SHARD}")))
    had = quotas.join(counts.groupBy("name").agg(F.sum("draws").alias("had")), "name", "left")
    had = had.withColumn("had", F.coalesce("had", F.lit(0).cast("long")))
    more, less = F.greatest(F.col("had") - F.col("n"), F.lit(0)), F.greatest(F.col("n") - F.col("had"), F.lit(0))
    had = totals_before(had.drop("low").withColumns({"more": more, "less": less}), [], ["name"], {"over": F.col("more"), "under": F.col("less")})
    had = hold(had.drop(PART))
    needed = ("rank", "n", "blocks", "whole", "rest", "last", "short_at")
    base = totals_before(counts, ["name"], ["shard"], {"base": F.col("draws")}, also=had.select("name", "over", *needed))
    nth = F.expr("row_number() over (partition by shard, name order by slot) - 1")
    numbered = drawn.join(base.drop(PART, "draws"), ["shard", "name"]).withColumn("i", F.col("base") + nth)
    own = numbered.where("i < n").select("shard", "slot", "name", "i", *needed)
    moved = numbered.where("i >= n").select("shard", "slot", (F.col("over") + F.col("i") - F.col("n")).alias("spare"))
    taken = _within(moved, "spare", _intervals(had, "under", "less", "had", *needed))
    taken = taken.withColumn("i", F.col("had") + F.col("spare") - F.col("low")).select("shard", "slot", "name", "i", *needed)
    # a source's numbers run through its blocks once or more, each time in an order of its own
    turn = own.unionByName(taken).withColumns({"turn": F.expr("i div blocks"), "at": F.expr("i % blocks")})
    index = permuted("at", "(rank * 4 + turn)", "blocks")
    given = turn.withColumn("block", index)
    held = F.when(F.col("block") < F.col("blocks") - 1, F.lit(block)).otherwise(F.col("last"))
    before = F.when(F.col("at") <= F.col("short_at"), F.col("at") * block).otherwise((F.col("at") - 1) * block + F.col("last"))
    words = F.when(F.col("turn") < F.col("whole"), held).otherwise(F.least(held, F.col("rest") - before))
    return given.select("shard", "slot", "name", "block", words.cast("long").alias("words"))


def pieces(mixed: Mix) -> DataFrame:
    """What each slot is made of: `shard`, `slot`, `at` (words of the slot before it), `doc`,
    `row`, `uid`, `first` (words of the text before it) and `words`."""
    b = mixed.block
    blocks = F.expr(f"explode(sequence(start div {b}, (start + size - 1) div {b}))")
    spread = mixed.docs.where("size > 0").select("doc", "row", "uid", "name", "start", "size", blocks.alias("block"))
    met = spread.join(mixed.slots, ["name", "block"])
    low = F.greatest(F.col("start"), F.col("block") * b)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * b + F.col("words"))
    return met.where(high > low).select(
        "shard", "slot", (low - F.col("block") * b).alias("at"), "doc", "row", "uid",
        (low - F.col("start")).alias("first"), (high - low).alias("words"),
    )


def slot_texts(df: DataFrame, mixed: Mix, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The mix itself: `shard`, `slot` and its `text`, words joined by one space."""
    texts = df.select(F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("whole"))
    texts = texts.dropDuplicates(["doc", "row"])
    cut = pieces(mixed).withColumnsRenamed({"doc": "_doc", "row": "_row"})
    both = cut.join(texts, cut["_doc"].eqNullSafe(texts["doc"]) & (cut["_row"] == texts["row"]))
    found = F.regexp_extract_all("whole", F.lit(f"([^{BLANKS}]+)"), F.lit(1))
    part = F.array_join(F.slice(found, (F.col("first") + 1).cast("int"), F.col("words").cast("int")), " ")
    listed = F.array_sort(F.collect_list(F.struct("at", part.alias("part"))))
    slots = both.groupBy("shard", "slot").agg(listed.alias("parts"))
    return slots.select("shard", "slot", F.array_join(F.col("parts.part"), " ").alias("text"))


def digest(mixed: Mix, key: str = "doc_id") -> DataFrame:
    """For each row: the words the mix takes of it, and its source's size and target."""
    taken = pieces(mixed).groupBy("uid").agg(F.sum("words").alias("taken"))
    both = mixed.docs.join(taken, "uid", "left")
    return both.select(
        F.col("doc").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )


def _permuted_sql(x: str, key: str, m: str, inverse: bool = False) -> str:
    """As `permuted`, in the check's SQL: k is a round's point or the index, r the round."""
    rounds = f"range({ROUNDS - 1}, -1, -1)" if inverse else f"range({ROUNDS})"
    mirror = f"((s.k - x.k) % {m} + {m}) % {m}"
    bit = swap_bit(f"greatest(x.k, {mirror})", key, "s.r")
    points = f"list_transform({rounds}, lambda r: {{'r': r, 'k': {swap_point(key, 'r', m)}}})"
    step = f"lambda x, s: {{'r': 0::bigint, 'k': case when {bit} then {mirror} else x.k end}}"
    return f"list_reduce({points}, {step}, {{'r': 0::bigint, 'k': ({x})::bigint}}).k"


ORACLE = f"""
with d as (
  select doc_id, coalesce('a' || source, 'z') as name,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents
), p as (
  select *, (sum(size) over (partition by name order by doc_id) - size)::bigint as start from d
), s0 as (
  select name, sum(size)::bigint as source_size, row_number() over (order by name) - 1 as rank from d group by name
), s1 as (
  select *, [3, 1, 2][rank % 3 + 1]::bigint as w, 2 * source_size as cap, sum(source_size) over ()::bigint as total from s0
), s2 as (
  select *, (coalesce(sum(cap) over before, 0))::bigint as caps, (sum(w) over () - coalesce(sum(w) over before, 0))::bigint as ws from s1
  window before as (order by cap * 6 // w, name rows between unbounded preceding and 1 preceding)
), s3 as (
  select *, 2 * cap * ws < (3 * total - 2 * caps) * w as above from s2
), level as (
  select (1.5 * max(total)::double - coalesce(sum(cap) filter (above), 0)::double) / (sum(w) - coalesce(sum(w) filter (above), 0))::double as u from s3
), s4 as (
  select *, case when above then cap::double else u * w end as target from s3, level
), s5 as (
  select *, least(floor(target + 0.5)::bigint, cap) as words, (source_size + {BLOCK - 1}) // {BLOCK} as blocks from s4
), s6 as (
  select *, case when source_size > 0 then words // source_size else 0 end as whole from s5
), s7 as (
  select *, words - whole * source_size as rest, source_size - (blocks - 1) * {BLOCK} as last,
    case when blocks > 0 then {_permuted_sql('blocks - 1', '(rank * 4 + whole)', 'blocks', True)} end as short_at from s6
), s8 as (
  select *, case when blocks = 0 then 0 else whole * blocks + case when rest <= short_at * {BLOCK} then (rest + {BLOCK - 1}) // {BLOCK}
      when rest <= short_at * {BLOCK} + last then short_at + 1
      else short_at + 1 + (rest - short_at * {BLOCK} - last + {BLOCK - 1}) // {BLOCK} end end as n from s7
), s9 as (
  select *, (sum(n) over (order by name) - n)::bigint as low from s8
), g as (
  select id as slot, ('0x' || substr(md5('{SEED}:' || id), 1, 15))::bigint % (select sum(n)::bigint from s9) as drawn
  from (select unnest(range((select sum(n)::bigint from s9))) as id)
), drawn as (
  select slot, name, row_number() over (partition by name order by slot) - 1 as i from g join s9 on drawn >= low and drawn < low + n
), h0 as (
  select s9.* exclude (low), coalesce(had, 0) as had from s9 left join (select name, count(*) as had from drawn group by name) c on c.name = s9.name
), h as (
  select *, (sum(greatest(had - n, 0)) over (order by name) - greatest(had - n, 0))::bigint as over_before,
    (sum(greatest(n - had, 0)) over (order by name) - greatest(n - had, 0))::bigint as under_before from h0
), spare as (
  select slot, over_before + i - n as spare from drawn join h on h.name = drawn.name where i >= n
), turns as (
  select h.*, slot, i from drawn join h on h.name = drawn.name where i < n
  union all
  select h.*, slot, had + spare - under_before as i from spare join h on spare >= under_before and spare < under_before + n - had
), given as (
  select *, i // blocks as turn, i % blocks as nth, {_permuted_sql('i % blocks', '(rank * 4 + i // blocks)', 'blocks')} as block from turns
), sized as (
  select *, case when block < blocks - 1 then {BLOCK} else last end as held,
    case when nth <= short_at then nth * {BLOCK} else (nth - 1) * {BLOCK} + last end as before_it from given
), slots as (
  select name, block, case when turn < whole then held else least(held, rest - before_it) end as words from sized
), spread as (
  select *, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) as block from p where size > 0
), taken as (
  select doc_id, sum(greatest(least(start + size, spread.block * {BLOCK} + words) - greatest(start, spread.block * {BLOCK}), 0))::bigint as taken
  from spread join slots on slots.name = spread.name and slots.block = spread.block group by doc_id
)
select p.doc_id, size, source_size, target, coalesce(taken, 0) as taken
from p join s4 on s4.name = p.name left join taken on taken.doc_id = p.doc_id
"""
