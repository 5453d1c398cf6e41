"""Mixing, the prefix trie and periodic runs: hand-made rows, plain versions, odd input."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dielens.llm import mixing, order, prefixes, queries, runs
from tests.compare import connect
from tests.llm import brute

SF = "/root/testdata/sf0.001"


# --- order ------------------------------------------------------------------------------------


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_totals_of_a_group_in_many_parts(many_parts):
    spark = many_parts
    rows = [("hot", i % 50, i) for i in range(400)] + [("cold", 1, 1), ("cold", 0, 0)]
    df = order.ranged(spark.createDataFrame(rows, "g string, a long, b long").repartition(5), "g", "a", "b")
    got = order.totals_before(df, ["g"], ["a", "b"], {"n": F.lit(1).cast("long"), "s": F.col("b")})
    assert got.where("g = 'hot'").select("part").distinct().count() > 1
    for g in ("hot", "cold"):
        found = sorted((r["a"], r["b"], r["n"], r["s"]) for r in got.where(F.col("g") == g).collect())
        mine = sorted((a, b) for x, a, b in rows if x == g)
        assert found == [(a, b, i, sum(y for _, y in mine[:i])) for i, (a, b) in enumerate(mine)]
    xored = order.totals_before(df, ["g"], ["a", "b"], {"x": F.col("b")}, xor=True).where("g = 'hot'")
    have = 0
    for r in sorted(xored.collect(), key=lambda r: (r["a"], r["b"])):
        assert r["x"] == have
        have ^= r["b"]


# --- mixing -----------------------------------------------------------------------------------


def targets(sizes: dict) -> dict:
    """Sources by code point, null last; the excess over twice a size is reshared."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        share = sum(w for s, w in weight.items() if s not in capped)
        above = {s for s in names if s not in capped and left * weight[s] / share > 2 * sizes[s] + 1e-9}
        if not above:
            return {s: float(2 * sizes[s]) if s in capped else left * weight[s] / share for s in names}
        capped |= above


MIXED = [(i, " ".join(f"w{i}x{j}" for j in range(i % 40)), "hot") for i in range(300)]
MIXED += [(1000 + i, "a b\tc\x0bd " * 60, s) for i, s in enumerate(["é", "", None, None, "z", "Z"])]
MIXED += [(None, "no id", "z"), (None, None, "z"), (7, "", "only empty"), (8, " \n ", "only empty"), (9, None, None)]
MIXED += [(2000, "the same row again", "copies")] * 90


@pytest.fixture(scope="module")
def mixed(spark):
    df = spark.createDataFrame([(*r, 5, "x") for r in MIXED], "doc_id long, text string, source string, size long, name string")
    return df.repartition(4), mixing.mix(df.repartition(4), block=16, shard=8)


def test_mixing_meets_its_targets(spark, mixed):
    df, mix = mixed
    sizes = Counter()
    for _, t, s in MIXED:
        sizes[s] += len(brute.words(t))
    wanted = targets(sizes)
    named = {("z" if s is None else "a" + s): s for s in sizes}
    uids = {r["uid"]: r for r in mix.docs.collect()}
    assert len(uids) == len(MIXED)
    got = Counter()
    for r in mixing.pieces(mix).groupBy("uid").agg(F.sum("words").alias("n")).collect():
        got[named[uids[r["uid"]]["name"]]] += r["n"]
        assert 0 < r["n"] <= 2 * uids[r["uid"]]["size"]
    for r in uids.values():
        s = named[r["name"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(wanted[s])
    for s, t in wanted.items():
        assert abs(got[s] - t) <= 0.5
    digest = mixing.digest(mix)
    assert digest.columns == ["doc_id", "size", "source_size", "target", "taken"] and digest.count() == len(MIXED)
    again = mixing.digest(mixing.mix(df.repartition(7), block=16, shard=8))
    assert sorted(map(str, digest.collect())) == sorted(map(str, again.collect()))


def test_mixing_slots_hold_their_words(mixed):
    df, mix = mixed
    slots = {(r["shard"], r["slot"]): r["words"] for r in mix.slots.collect()}
    texts = {(r["shard"], r["slot"]): r["text"].split(" ") for r in mixing.slot_texts(df, mix).collect()}
    assert len(slots) == mix.slots.count() and sorted(s for _, s in slots) == list(range(len(slots)))
    assert {k: len(t) for k, t in texts.items()} == slots
    assert all(n <= 16 for n in slots.values()) and all(slot // 8 == shard for shard, slot in slots)
    where = {w: d for d, t, _ in MIXED[:300] for w in t.split()}
    for t in texts.values():
        assert len({w in where for w in t}) == 1  # a slot is of one source


def test_mixing_counts_look_multinomial(mixed):
    _, mix = mixed
    n, shards = mix.slots.count(), mix.slots.select("shard").distinct().count()
    counts = {(r["shard"], r["name"]): r["count"] for r in mix.slots.groupBy("shard", "name").count().collect()}
    share = mix.slots.where("name = 'ahot'").count() / n
    hot = np.array([counts.get((s, "ahot"), 0) for s in range(shards - 1)])
    assert 0.4 < hot.var() / (8 * share * (1 - share)) < 2.0


def test_permutations(spark):
    for m in (1, 2, 7, 100):
        ids = spark.range(m).withColumns({"m": F.lit(m).cast("long"), "k": F.lit(5).cast("long")})
        got = ids.select("id", mixing.permuted("id", "k", "m").alias("to")).withColumns({"m": F.lit(m).cast("long"), "k": F.lit(5).cast("long")})
        rows = got.withColumn("back", mixing.permuted("to", "k", "m", inverse=True)).collect()
        assert sorted(r["to"] for r in rows) == list(range(m)) and all(r["id"] == r["back"] for r in rows)
    assert sum(r["id"] == r["to"] for r in rows) < 12


def test_mixing_of_nothing(spark, mixed):
    df, _ = mixed
    assert mixing.digest(mixing.mix(df.where("false"))).count() == 0
    blank = mixing.digest(mixing.mix(df.where("source = 'only empty'"))).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in blank] == [(0, 0, 0.0, 0)] * 2


# --- prefixes ---------------------------------------------------------------------------------

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TALK = [(c, t, "user" if t % 2 else None, None if t == 3 else f"turn {t} of {c % 3}") for c in range(60) for t in range(c % 9)]
TALK += [(c, t, "user", "all say this") for c in range(100, 400) for t in range(2)]
TALK += [(500, t, "u", f"word {t % 3}") for t in range(300)] + [(501, t, "u", f"word {t % 3}") for t in range(250)]
TALK += [(600, None, "late", "null turn first"), (600, 0, "a", "x"), (600, None, "late", "null turn first"), (600, 0, "a", "x")]
TALK += [(None, 1, "u", "nobody"), (-7, 0, "u", "minus"), (-7, 1, "u", "minus"), (21, 5, "", ""), (None, None, None, None)]


def trie_rows(df):
    got = prefixes.trie(prefixes.rebuilt(df))
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_trie(spark):
    rows = [(*r, 1, "clash") for r in TALK]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth long, x string").repartition(6)
    assert trie_rows(df) == sorted(brute.prefix_trie(TALK), key=str)
    assert trie_rows(df.where("false")) == []
    assert trie_rows(df.where("conv_id is null")) == []


def test_trie_on_a_whole_table(spark):
    rows = connect(SF).execute("select conv_id, turn, role, text from conversations").fetchall()
    found = sorted((tuple(r) for r in queries.op12_prefix_trie(spark, SF).collect()), key=str)
    assert found == sorted(brute.prefix_trie(rows), key=str)


def test_trie_is_the_same_for_any_block(spark):
    few = [r for r in TALK if r[0] is not None and r[0] in (1, 4, 5, 7, 8, 14, 17, 101, 102)]
    given = prefixes.as_they_are(spark.createDataFrame(few, "conv_id long, turn long, role string, text string"))
    one, many = (sorted(map(str, prefixes.trie(given, turns).collect())) for turns in (1, 64))
    assert one == many and len(one) > 10


# --- runs -------------------------------------------------------------------------------------

RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), min_size=1, max_size=6), st.integers(1, 12), st.integers(0, 60))
def test_runs_of_random_words(texts, period, at):
    texts = [*texts, *(t[:at] + [t[at + (i - at) % period] for i in range(at, len(t)) if at + period <= len(t)] for t in texts)]
    found = [list(zip(*(x.tolist() for x in f), strict=True)) for f in runs.runs_of(texts)]
    assert found == [brute.runs(t) for t in texts]


def test_runs_of_long_words():
    deep = [0, 1]
    while len(deep) < 3000:  # Fibonacci words are full of runs
        deep = deep + deep[: len(deep) * 5 // 8]
    cases = [[1] * 3000, [1, 2] * 1500, list(range(667)) * 3, deep[:1500], list(range(2000)), [1] * 11, [1] * 12, list(range(6)) * 2, list(range(5)) * 2]
    found = [list(zip(*(x.tolist() for x in f), strict=True)) for f in runs.runs_of(cases)]
    assert found == [brute.runs(c) for c in cases]
    assert [len(f) for f in found[5:]] == [0, 1, 1, 0]


def test_grammar_derives_its_text():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 4, 500), np.zeros(100, dtype=int), rng.integers(0, 4, 3)])
    piece = np.repeat([0, 1, 2], [400, 150, 53])
    grammar = runs.re_pair(ids, piece)
    for symbol in np.unique(grammar.derived):
        starts = grammar.start[grammar.derived == symbol]
        n = grammar.length[symbol]
        assert len({tuple(ids[s : s + n]) for s in starts}) == 1 and 0 < grammar.middle[symbol] < n
        assert all(len(set(piece[s : s + n])) == 1 for s in starts)
    whole = {(s, grammar.length[d]) for s, d in zip(grammar.start, grammar.derived, strict=True)}
    assert {(0, 400), (400, 150), (550, 53)} <= whole
    assert len(np.unique(grammar.derived)) < len(grammar.derived)


EDGES = {
    1: None, 2: "", 3: " \n\t", 4: "a " * 400, 5: "b c\x0b" * 20, 6: "x", 24: "one two three four five six " * 8,
    7: "tail " + "q w e r t y u i " * 3 + "end", 8: "é ü " * 9 + "\x1c 漢字 " * 12, **{i: f"w{i} " * 3 + "k l m n o p q r " * 5 for i in range(100, 140)},
}


def test_periodic_runs(spark):
    rows = [(d, t, 1, "clash") for d, t in EDGES.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_runs long, runs string").repartition(3)
    got = runs.digest(runs.periodic_runs(df, stretch=True)).collect()
    assert {r["doc_id"]: tuple(r[c] for c in RUN_COLUMNS) for r in got} == brute.periodic_runs(EDGES)
    assert runs.digest(runs.periodic_runs(df.where("false"), stretch=True)).count() == 0
    odd = spark.createDataFrame([(None, "r s " * 30), (5, "a " * 30), (5, "a " * 30), (None, None)], "doc_id long, text string")
    found = runs.periodic_runs(odd).collect()
    assert sorted((r["doc_id"] or 0, len(r["runs"]), r["collapsed"]) for r in found) == [(0, 0, ""), (0, 1, "r s"), (5, 1, "a"), (5, 1, "a")]


def test_periodic_runs_of_a_whole_table(spark):
    docs = dict(connect(SF).execute("select doc_id, text from documents").fetchall())
    docs = {d: t for d, t in docs.items() if len(brute.words(t)) < 2500}
    found = {r["doc_id"]: tuple(r[c] for c in RUN_COLUMNS) for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert len(found) == len(dict(connect(SF).execute("select doc_id, 1 from documents").fetchall()))
    assert {d: found[d] for d in docs} == brute.periodic_runs(docs)


def test_blocks_of_texts_do_not_matter(spark, monkeypatch):
    words = [w for t in EDGES.values() for w in brute.words(t)]
    whole = [list(map(words.index, brute.words(t))) for t in EDGES.values()]
    together = runs.runs_of(whole)
    for one, f in zip(whole, together, strict=True):
        alone = runs.runs_of([one])[0]
        assert all(np.array_equal(a, b) for a, b in zip(alone, f, strict=True))
