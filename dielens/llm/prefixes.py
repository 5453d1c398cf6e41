"""The trie of conversation prefixes, by digests of blocks of turns.

A conversation's turns are cut into blocks of fixed length. Conversations are grouped by their
successive block digests: one row stands for all those that share a block and all before it.
Where a group goes on in one way only, each turn of the block is a node with the group's
members; only where it goes on in several are the turns inside these blocks compared.
A prefix is known by two exclusive ors of position-salted 64-bit hashes of its turns, which
can be taken over blocks and parts of blocks alike. Sums over subtrees reach twice as deep
with each step, so a long conversation costs steps by the logarithm of its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dielens.llm.common import BLANKS
from dielens.llm.order import PART, ranged, totals_before
from dielens.plans.hold import hold

BLOCK_TURNS = 4
#: Parts of the classes of one group where they meet what is known of it.
SALTS = 64
#: Bytes of a list of ids that are passed on together.
LIST_BYTES = 1 << 20


@dataclass(frozen=True)
class Conversations:
    """turns: `conv`, `depth` (1 for the first), hashes `x` and `y` of role and text, `words`
    of the text. convs: `conv` and `depth`, its number of turns, 0 included."""

    turns: DataFrame
    convs: DataFrame


def _hash(salt: int, *parts: Column) -> Column:
    return F.xxhash64(F.lit(salt), *parts)


def ordered(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """`conv`, `at` (0 for the first turn), `x`, `y`, `words`, `part`; null turns come first."""
    says = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    hashed = hold(
        df.where(F.col(key).isNotNull()).select(
            F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), says[0].alias("role"),
            _hash(1, *says).alias("x"), _hash(2, *says).alias("y"),
            F.regexp_count(says[1], F.lit(f"[^{BLANKS}]+")).cast("long").alias("words"),
            F.monotonically_increasing_id().alias("uid"),
        )
    )
    order = ("turn", "role", "x", "y", "uid")
    dealt = ranged(hashed, "conv", *order)
    return totals_before(dealt, ["conv"], order, {"at": F.lit(1).cast("long")}).drop("turn", "role", "uid")


def as_they_are(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Conversations:
    """The conversations of df (see `rebuilt` for odd rows), each with its own turns."""
    own = ordered(df, key, turn, role, text)
    convs = own.groupBy("conv").agg(F.count("*").alias("depth"))
    return Conversations(own.withColumn("depth", F.col("at") + 1).drop("at", PART), convs)


def rebuilt(
    df: DataFrame, family: int = 20, most: int = 4, key: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> Conversations:
    """Each conversation with the first turns of the first of its family.

    Conversation c takes the first h turns of c - c % family, h its crc32 modulo `most`, then
    its own after its first h. Turns go by number, null first; equal numbers by role, then by
    a hash of the text. Null roles and texts are empty. Rows without a conversation belong to
    none and are left out; repeated rows are turns like others; other columns are not read.
    """
    own = hold(ordered(df, key, turn, role, text))
    convs = own.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = hold(convs.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % family}))
    first = convs.select(F.col("conv").alias("base"), F.col("n").alias("has"))
    known = convs.join(first, "base", "left").select("conv", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("lent"))
    # a family has `family` members at most on either side of zero, and each lends few turns
    lent = own.where((F.col("at") < most) & (F.col("conv") % family == 0)).select(F.col("conv").alias("base"), "at", "x", "y", "words")
    taken = convs.join(lent, "base").where("at < h").select("conv", (F.col("at") + 1).alias("depth"), "x", "y", "words")
    by_part = own.select(PART, "conv").distinct().join(known, "conv")
    kept = own.join(by_part, [PART, "conv"]).where("at >= h")
    kept = kept.select("conv", (F.col("at") - F.col("h") + F.col("lent") + 1).alias("depth"), "x", "y", "words")
    depth = F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    lengths = known.join(convs.select("conv", "n"), "conv").select("conv", depth.alias("depth"))
    return Conversations(taken.unionByName(kept), hold(lengths))


def _spread(classes: DataFrame) -> DataFrame:
    """The turns of each row's block, with the prefix that ends in each and the one before."""
    upto = lambda side, i: F.aggregate(
        F.slice(F.col("turns"), F.lit(1), i), F.col(f"before_{side}"), lambda have, t: have.bitwiseXOR(t[side])
    )
    nodes = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["depth"].alias("depth"), t["words"].alias("words"), upto("x", i + 1).alias("x"), upto("y", i + 1).alias("y"),
            F.when(i > 0, upto("x", i)).otherwise(F.col("before_x")).alias("up_x"),
            F.when(i > 0, upto("y", i)).otherwise(F.col("before_y")).alias("up_y"),
        ),
    )
    return classes.select("n_convs", "conv_id", F.inline(nodes))


def prefix_nodes(given: Conversations, block_turns: int = BLOCK_TURNS) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends). nodes: prefix `x`, `y`, the prefix before it `up_x`, `up_y` (null for the
    root), `depth`, `conv_id`, `n_convs`, `words` of its last text. ends: `x`, `y`, `conv`."""
    salted = given.turns.select(
        "conv", F.expr(f"(depth - 1) div {block_turns}").alias("block"), "depth", "words",
        _hash(3, F.col("depth"), F.col("x")).alias("x"), _hash(4, F.col("depth"), F.col("y")).alias("y"),
    )
    blocks = salted.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("depth", "x", "y", "words"))).alias("turns"),
        F.bit_xor("x").alias("x"),
        F.bit_xor("y").alias("y"),
    )
    digests = {"before_x": F.col("x"), "before_y": F.col("y")}
    dealt = ranged(blocks, "conv", "block")
    lengths = given.convs.select("conv", F.col("depth").alias("whole"))
    chained = hold(totals_before(dealt, ["conv"], ["block"], digests, also=lengths, xor=True))
    group = ["block", "before_x", "before_y"]
    classes = hold(
        chained.groupBy(*group, "x", "y").agg(
            F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), F.first("turns").alias("turns")
        )
    )
    ways = classes.groupBy(*group).agg(F.count("*").alias("ways")).where("ways > 1")
    # the root, or a first block that all share, goes on in very many ways: dealt by salt
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = classes.withColumn("salt", F.pmod(F.xxhash64("x", "y"), F.lit(SALTS)).cast("int")).drop("x", "y")
    told = salted.join(ways.select(*group, F.lit(True).alias("diverge"), salts), [*group, "salt"], "left")
    told = told.drop("salt").withColumn("diverge", F.coalesce("diverge", F.lit(False)))
    same = _spread(told.where("not diverge"))
    apart = _spread(told.where("diverge")).groupBy("x", "y").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("depth", "words", "up_x", "up_y")],
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = given.convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    root = root.select("*", *[zero.alias(c) for c in ("depth", "words", "x", "y")], none.alias("up_x"), none.alias("up_y"))
    last = chained.where(F.col("block") == F.expr(f"(whole - 1) div {block_turns}"))
    ends = last.select("conv", *[F.col(f"before_{c}").bitwiseXOR(F.col(c)).alias(c) for c in ("x", "y")])
    turnless = given.convs.where("depth = 0").select("conv", zero.alias("x"), zero.alias("y"))
    return hold(same.unionByName(apart).unionByName(root)), ends.unionByName(turnless)


def below(nodes: DataFrame, values: dict[str, Column]) -> DataFrame:
    """`x`, `y` and for each name the sum of the value over the node's subtree, itself included.

    A step adds the sums of the nodes that are 2^k deeper, which reach 2^k deep themselves.
    """
    reach = 1
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = hold(nodes.select("x", "y", "depth", "up_x", "up_y", *[c.alias(n) for n, c in values.items()]))
    while reach <= deepest:
        deep = sums.where(F.col("depth") >= reach)
        more = deep.groupBy("up_x", "up_y").agg(*[F.sum(n).alias(f"_{n}") for n in values])
        more = more.withColumnsRenamed({"up_x": "x", "up_y": "y"})
        added = sums.join(more, ["x", "y"], "left").withColumns(
            {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in values}
        )
        above = sums.select(F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("up_x").alias("_x"), F.col("up_y").alias("_y"))
        columns = ["x", "y", "depth", "up_x", "up_y", *values]
        reach *= 2
        far = added.where(F.col("depth") >= reach).select(*columns).join(above, ["up_x", "up_y"])
        far = far.withColumns({"up_x": F.col("_x"), "up_y": F.col("_y")}).select(*columns)
        near = added.where(F.col("depth") < reach).select(*columns)
        sums = hold(far.unionByName(near))
    return sums.select("x", "y", *values)


def id_lists(ends: DataFrame) -> DataFrame:
    """`x`, `y`, `ends_sha256`: SHA-256 of the ids that end at a prefix, rising, with commas.

    The ids are written out in parallel, in stretches of their order; a last task of a prefix
    only feeds these texts to its hash, a stretch at a time.
    """

    def lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, size, first = None, [], 0, 0
        out = lambda: pa.RecordBatch.from_pylist([{"x": place[0], "y": place[1], "first": first, "ids": ",".join(held)}], schema=kind)
        kind = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            done: list[dict] = []
            for x, y, conv in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "conv")), strict=True):
                if held and ((x, y) != place or size > LIST_BYTES):
                    done.append({"x": place[0], "y": place[1], "first": first, "ids": ",".join(held)})
                    held, size = [], 0
                if not held:
                    place, first = (x, y), conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=kind)
        if held:
            yield out()

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])
        place, digest = None, None
        for batch in batches:
            done: list[dict] = []
            for x, y, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "ids")), strict=True):
                if (x, y) != place:
                    if place:
                        done.append({"x": place[0], "y": place[1], "ends_sha256": digest.hexdigest()})
                    place, digest = (x, y), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=kind)
        if place:
            yield pa.RecordBatch.from_pylist([{"x": place[0], "y": place[1], "ends_sha256": digest.hexdigest()}], schema=kind)

    order = ["x", "y", "conv"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    written = dealt.mapInArrow(lists, "x long, y long, first long, ids string")
    together = written.repartition("x", "y").sortWithinPartitions("x", "y", "first")
    return together.mapInArrow(hashes, "x long, y long, ends_sha256 string")


def trie(given: Conversations, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each different sequence of first turns, the empty one included.

    `conv_id` is the smallest conversation that begins so, `parent_conv_id` that of the
    sequence without its last turn. `n_convs` begin so, `n_children` sequences go on from it
    by one turn, `n_leaves` sequences from it on have none that go on; `saved_tokens` are the
    words a cache of prefixes saves in the subtree: of each last text all uses but the first.
    `ends_sha256` is of the conversations that end there. Without conversations, no rows.
    """
    nodes, ends = prefix_nodes(given, block_turns)
    children = nodes.where("up_x is not null").groupBy("up_x", "up_y").agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed({"up_x": "x", "up_y": "y"})
    told = hold(nodes.join(children, ["x", "y"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    leaf = (F.col("n_children") == 0).cast("long")
    sums = below(told, {"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    parents = told.select(F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("parent_conv_id"))
    root = told.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    placed = told.where("depth > 0").join(parents, ["up_x", "up_y"]).unionByName(root)
    none = hashlib.sha256(b"").hexdigest()
    return (
        placed.join(sums, ["x", "y"])
        .join(id_lists(ends), ["x", "y"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )


_BYTE = "case when y % 2 = 1 then xor(y >> 1, 3988292384) else y >> 1 end"
#: crc32 of a decimal number, as the check's SQL.
_CRC = f"""xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda a, c: xor(a >> 8, list_reduce(range(8), lambda y, i: {_BYTE}, xor(a, c) % 256)), 4294967295::bigint), 4294967295)"""

ORACLE = f"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as nth from conversations where conv_id is not null
), c as (
  select conv_id, n, {_CRC} % 4 as h, conv_id - conv_id % 20 as base from (select conv_id, count(*) as n from t group by 1)
), r as (
  select c.conv_id, b.nth + 1 as d, b.role, b.text from c join t b on b.conv_id = c.base and b.nth < c.h
  union all
  select c.conv_id, t.nth - c.h + least(c.h, coalesce(b.n, 0)) + 1, t.role, t.text
  from c join t on t.conv_id = c.conv_id left join c b on b.conv_id = c.base where t.nth >= c.h
), q as (
  select conv_id, d, text, string_agg(md5(length(role) || ':' || role || text), '/') over (partition by conv_id order by d) as path from r
), n0 as (
  select path, d, count(*) as n_convs, min(conv_id) as conv_id,
    any_value(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) as words from q group by path, d
  union all
  select '', 0, count(*), min(conv_id), 0 from c having count(*) > 0
), n1 as (
  select *, case when d > 1 then left(path, 33 * (d - 1) - 1) when d = 1 then '' end as up from n0
), n2 as (
  select n1.*, coalesce(n_children, 0) as n_children from n1 left join (select up, count(*) as n_children from n1 group by up) k on k.up = n1.path
), s as (
  select case when k = 0 then '' else left(path, 33 * k - 1) end as path, sum((n_children = 0)::bigint)::bigint as n_leaves,
    sum((n_convs - 1) * words)::bigint as saved_tokens from (select *, unnest(range(d + 1)) as k from n2) group by 1
), e as (
  select path, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
  from (select c.conv_id, coalesce(arg_max(path, d), '') as path from c left join q on q.conv_id = c.conv_id group by 1) group by path
)
select n2.conv_id, n2.d as depth, p.conv_id as parent_conv_id, n2.n_convs, n2.n_children, n_leaves, saved_tokens,
  coalesce(ends_sha256, sha256('')) as ends_sha256
from n2 left join n2 p on p.path = n2.up join s on s.path = n2.path left join e on e.path = n2.path
"""
