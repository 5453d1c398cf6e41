"""Each operator against a plain version, on whole small tables and on hand-made rows."""

import base64
import math
import string

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql.functions import col, lit

from dielens.llm import bpe, licenses, lines, lm, packing, quality, queries, simhash, suffixes, toxicity, vectors
from tests.compare import connect, differences
from tests.llm import brute

SF = "/root/testdata/sf0.001"
LINE = "This line is long enough to count as shared."
PASSAGE = " ".join(f"word{i * i}" for i in range(60))
EDGES = {
    1: None,
    2: "",
    3: " \n\t \n",
    4: f"{LINE}\nalone here\n  {LINE.upper()}  ",
    5: f"x\n{LINE}",
    6: f"{LINE}\n{LINE}\nshort\nshort",
    7: "short\nshort\nother",
    8: f"before {PASSAGE} after",
    9: f"{PASSAGE}",
    10: f"other {PASSAGE}{PASSAGE} end",
    11: "a" * 700,
    12: "ñandú ÇA ß 漢字   \x1c x́ İ ſ don't 12345 \n\n  tail ",
    13: "the same words " * 30,
    14: "the same words " * 30,
    15: "w " * 30_000 + "end",
    16: "é" * 150 + "b" * 60,
    17: "é" * 149 + "b" * 60,
    18: "idiot idiot <|endoftext|> ''s 's",
    19: f"{LINE}  \u2028",
    20: f"{LINE}\u2028",
    21: f"{LINE} \u2028\n{LINE}\x85",
    22: "A <|endoftext|> b <|ENDOFTEXT|> <|startoftext|>c <|endoftext",
}


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(d, t, "src" if d % 3 else None, "clash", 1) for d, t in EDGES.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, spans string, gone long").repartition(3)


@pytest.fixture(scope="module")
def empty(edges):
    return edges.where("doc_id < 0")


@pytest.fixture(scope="module")
def small():
    return dict(connect(SF).execute("select doc_id, text from documents").fetchall())


def by_id(df, *columns, key="doc_id"):
    rows = df.collect()
    out = {r[key]: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


def nulls_and_repeats(spark):
    rows = [(None, PASSAGE), (None, None), (7, PASSAGE), (7, PASSAGE), (8, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- byte-level BPE -----------------------------------------------------------------------


def ranks():
    with open(public_tokenizers.path(queries.BYTE_RANKS), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def encoded(df):
    path = public_tokenizers.path(queries.BYTE_RANKS)
    return bpe.digests(bpe.encode(df, path, public_tokenizers.PATTERN), bpe.decoder(df, path))


def test_bpe(spark, edges, empty, small):
    columns = ("n_tokens", "ids_sha256", "decoded_sha256")
    assert by_id(encoded(edges), *columns) == brute.bpe(EDGES, ranks(), public_tokenizers.PATTERN)
    found = by_id(queries.op1_byte_bpe(spark, SF), *columns)
    assert found == brute.bpe(small, ranks(), public_tokenizers.PATTERN)
    assert encoded(empty).count() == 0
    assert encoded(nulls_and_repeats(spark)).count() == 5


def test_bpe_of_odd_words():
    """Random byte words, so that pairs come up that no text has."""
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks(), special_tokens={})
    rng, vocabulary = np.random.default_rng(3), bpe.Ranks(open(public_tokenizers.path(queries.BYTE_RANKS), "rb").read())
    words = [bytes(rng.choice(list(b"aeinrst =-.\xc3\xa9"), rng.integers(1, 40))) for _ in range(3000)]
    words += [b"=" * n for n in range(1, 90)] + [b"ab" * 40, b"a" * 3000]
    ids, counts = bpe.replay(words, vocabulary)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [own._core_bpe.encode_single_piece(w) for w in words]


def test_bpe_without_settled_ranks():
    """Lower ranks that come up later are still taken first."""
    singles = {bytes([b]): b for b in range(256)}
    vocabulary = bpe.Ranks(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in {**singles, b"ab": 301, b"abc": 300, b"ba": 302}.items()))
    assert not vocabulary.settled[301]
    ids, counts = bpe.replay([b"abcabab", b"bab"], vocabulary)
    assert ids.tolist() == [300, 301, 301, 98, 301] and counts.tolist() == [3, 2]


# --- licences --------------------------------------------------------------------------------


def test_licenses(spark, empty):
    rows = [
        (1, "Some text\nLicensed under the Apache License, Version 2.0.\nmore"),
        (2, "licensed UNDER the apache license,\nversion 2.0"),
        (3, "Licensed under the Apache"),
        (4, None),
        (5, ""),
        (6, "..."),
        (None, "Released under the MIT License."),
        (7, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (7, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (8, "word " * 50_000),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    best = sorted((r["doc_id"] or 0, r["license"], r["line_no"], r["n_matched"]) for r in found if r["license"])
    assert best == [(0, "MIT", 0, 1), (1, "Apache-2.0", 1, 2), (2, "Apache-2.0", -1, 1), (7, "MIT", 0, 2), (7, "MIT", 0, 2)]
    assert len(found) == 10 and licenses.scan(empty).count() == 0


def plain_places(text, templates, at_least=0.8):
    """Every stretch of bigrams against every template: places and the best coefficient."""
    import re

    words = [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]
    pairs, found = list(map(" ".join, zip(words, words[1:], strict=False))), []
    for name, body in templates:
        grams = set(licenses.template_grams(body))
        for i in range(len(pairs)):
            shared, others = set(), 0
            for j in range(i, len(pairs)):
                if pairs[j] in grams:
                    shared.add(pairs[j])
                else:
                    others += 1
                dice = 2 * len(shared) / (len(shared) + others + len(grams))
                if dice >= at_least:
                    found.append((dice, i, j, name))
    dice, _, _, name = min(found, key=lambda m: (-m[0], m[1], m[3]), default=(0.0, None, None, None))
    return (bool(found), name, pytest.approx(dice))


def test_license_places(spark, empty):
    """Wrapped notices in long texts, notices within a line, repeats, and whole paragraphs."""
    rng = np.random.default_rng(6)
    filler = lambda n: " ".join(rng.choice(["of", "the", "license", "under", "grain", "mill", "river"], n))
    wrapped = "Licensed under the\nApache License,\n  Version 2.0."
    permission = licenses.MIT_PERMISSION.replace(" and", "\n# and")
    rows = [
        (1, f"{filler(400)}\n{wrapped}\n{filler(400)}"),
        (2, "Copyright 2020 Example Authors, all rights reserved. Licensed under the Apache License, Version 2.0."),
        (3, "\n".join([wrapped] * 40)),
        (4, f"{filler(100)}\n{permission}\n{filler(100)}"),
        (5, f"{licenses.MIT_PERMISSION}\n\n{licenses.MIT_REST}"),
        (6, "Licensed under the Apache License Version"),
        (7, "Licensed under the well known Apache License, Version 2.0 of 2004"),
        (8, filler(300)),
        (9, None),
        (10, "..."),
        (11, "x"),
        (None, "Released under the MIT License."),
        (12, "Released under the MIT License.\n\nLicensed under CC\nBY-NC 4.0."),
    ]
    done = licenses.places(spark.createDataFrame(rows, "doc_id long, text string"))
    found = by_id(done, "n_places", "license", "dice", "first_line", "last_line")
    assert {d: (n > 0, name, dice) for d, (n, name, dice, _, _) in found.items()} == {
        d: plain_places(t, licenses.PASSAGES) for d, t in rows
    }
    assert found[1] == (1, "Apache-2.0", 1.0, 1, 3) and found[2][:3] == (1, "Apache-2.0", 1.0)
    assert found[3] == (40, "Apache-2.0", 1.0, 0, 2) and found[5][:3] == (1, "MIT", 1.0)
    assert found[4][1:3] == ("MIT", 1.0) and found[4][3:] == (1, permission.count("\n") + 1)
    assert found[12] == (2, "MIT", 1.0, 0, 0) and found[8] == found[9] == (0, None, 0.0, -2, -2)
    assert licenses.places(empty).count() == 0


# --- language model ----------------------------------------------------------------------------


def test_lm(spark, edges, empty):
    docs = dict(connect("/root/testdata/sf0.01").execute("select doc_id, text from documents").fetchall())
    columns = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    found = by_id(queries.op3_lm_scoring(spark, "/root/testdata/sf0.01"), *columns)
    import zlib
    from collections import Counter

    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in docs}
    tokens = {d: [*brute.lower_words(t), "\n"] for d, t in docs.items()}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total = sum(counts.values())
    below = math.log10(total + 0.1 * (len(counts) + 1))
    for d, (out, n, known, trained, base, score) in found.items():
        assert (out, n, known, trained) == (held[d], len(tokens[d]), sum(w in counts for w in tokens[d]), total)
        assert base == pytest.approx(sum(math.log10(counts[w] + 0.1) - below for w in tokens[d]), abs=1e-6)
        assert score < 0
    better = [(s - b) / n for out, n, _, _, b, s in found.values() if out]
    assert np.mean(better) > 0.02
    assert lm.score_documents(empty).count() == 0
    assert lm.score_documents(edges).count() == len(EDGES)
    assert lm.score_documents(nulls_and_repeats(spark)).count() == 5


def test_lm_is_normalised(monkeypatch):
    """Scores of all words after a context, and of one unseen word in each class, add up."""
    model = lm.LogBilinear(lm.LogBilinear.start(np.arange(lm.CLASSES) + 1.0, 1) * 3)
    assert np.allclose((10.0 ** model.table().astype(np.float64)).sum(axis=1), 1, atol=1e-4)


def test_lm_gradient():
    """A class that always follows another becomes likely after it."""
    counts = np.ones(lm.CLASSES) * 100
    trainer = lm.Trainer(lm.LogBilinear.start(counts, 1), counts, 1, batch=256)
    rng = np.random.default_rng(0)
    target = np.tile([3, 5], 20_000)
    target[rng.random(40_000) < 0.3] = 9
    trainer.learn(target, lm.with_context(target, np.zeros(40_000, dtype=np.int64)))
    table = 10 ** trainer.model.table().reshape((lm.CLASSES,) * 3)
    assert table[3, 5, 5] > 0.25 and table[5, 3, 3] > 0.25 and table[3, 5, 3] < 0.1


def test_lm_rare_words_meet_their_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 2)
    rows = [(i, f"a b c{i % 4} d{i % 7} e{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few = by_id(lm.score_documents(df), "n_known", "base_score")
    counts = lm.word_counts(df)
    known = lm.vocabulary(counts)
    bounded = lm.Vocabulary(known.total, known.distinct, known.words[:190], known.counts[:190], known.within, known.classes, "few")
    assert len(few) == 60 and bounded.total == 360


# --- toxicity --------------------------------------------------------------------------------------


def test_toxicity(spark, edges, empty):
    scored = queries.op4_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = scored[scored.held_out].merge(labels, on="doc_id")
    a, b = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert (a[:, None] > b[None, :]).mean() + (a[:, None] == b[None, :]).mean() / 2 > 0.7
    assert len(scored) == 1000 and scored.score.between(0, 1).all() and scored.score.notna().all()
    assert (scored.predicted == (scored.score >= 0.3)).all()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert by_id(toxicity.score_documents(edges, none), "score", "predicted") == dict.fromkeys(EDGES, (0.0, 0))
    assert toxicity.score_documents(empty, none).count() == 0
    odd = spark.createDataFrame([(None, 1), (8, None), (7, 1), (7, 0)], "doc_id long, toxic int")
    assert toxicity.score_documents(nulls_and_repeats(spark), odd).count() == 5


def test_training_rows_are_bounded(spark):
    """An id with very many rows, equal and different ones, does not pass the bound."""
    rows = [(1, "the same text")] * 300 + [(1, f"text {i}") for i in range(100)] + [(i, f"other {i}") for i in range(2, 102)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 102)], "doc_id long, toxic int")
    rows_of = lambda most: toxicity.training_rows(docs, labels, toxicity.Settings(most_rows=most), "doc_id", "text")
    assert rows_of(50).count() == 50 and rows_of(10_000).count() == 500
    assert rows_of(50).where("key = 1").count() < 50


def test_neutral_mentions_are_spared():
    """An identity term that stands in most toxic texts gains almost no weight."""
    rng = np.random.default_rng(1)
    texts, label = [], []
    for i in range(600):
        toxic = i % 3 == 0
        words = {f"w{j}" for j in rng.integers(0, 50, 8)} | ({"stupid"} if toxic else set())
        texts.append(words | ({"muslims"} if rng.random() < (0.8 if toxic else 0.1) else set()))
        label.append(float(toxic))

    def model(penalty):
        settings = toxicity.Settings(penalty=penalty)
        others = [toxicity.swapped(t, settings.identities) for t in texts]
        as_arrays = lambda x: None if x is None else np.array(toxicity.features(x))
        return toxicity.fit([as_arrays(t) for t in texts], [as_arrays(o) for o in others], np.array(label), settings)

    plain, fair = model(0.0), model(10.0)
    assert fair.score("muslims pray here") < plain.score("muslims pray here")
    change = lambda m: abs(m.score("muslims pray here") - m.score("buddhists pray here"))
    assert change(fair) < 0.1 and change(fair) < change(plain) / 2
    assert fair.score("stupid muslims") > 0.5 > fair.score("muslims")


# --- lines -----------------------------------------------------------------------------------------


def test_lines(spark, edges, empty, small):
    columns = ("n_lines", "n_dropped", "kept_sha256")
    done = lines.drop_shared_lines(edges)
    assert done.columns == [*edges.columns, "n_lines", "n_dropped"]
    assert by_id(lines.digest(done), *columns) == brute.line_dedup(EDGES)
    assert by_id(queries.op5_line_dedup(spark, SF), *columns) == brute.line_dedup(small)
    assert lines.drop_shared_lines(empty).count() == 0
    rows = [(None, LINE), (1, LINE), (2, LINE), (2, LINE), (3, LINE), (None, None)]
    found = lines.drop_shared_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_dropped"]) for r in found) == [(0, 0), (0, 1), (1, 1), (2, 1), (2, 1), (3, 0)]


def test_line_keys(spark):
    """Blanks of ASCII alone go, and A-Z alone are lowered, in lines of any characters."""
    ends = ["", " ", "\t\x0b\x0c\r ", "\x1c", "\x85", "\u2028", "\xa0", "\0", "é", "😀", "İ"]
    found = [a + m + b for a in ends for b in ends for m in ("", "Aa Zz", "ÀZ\tK", "ſ 漢 x")]
    df = spark.createDataFrame([(x,) for x in found], "line string").repartition(2)
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    for r in df.select("line", lines.line_key(col("line")).alias("key")).collect():
        assert r["key"] == r["line"].strip(" \t\n\v\f\r").translate(lower)


# --- SimHash --------------------------------------------------------------------------------------


def test_simhash(spark, edges, empty, small):
    columns = ("fingerprint", "component_id")
    assert by_id(simhash.near_duplicates(edges), *columns) == brute.simhash(EDGES)
    assert by_id(queries.op6_simhash(spark, SF), *columns) == brute.simhash(small)
    assert simhash.near_duplicates(empty).count() == 0
    found = simhash.near_duplicates(nulls_and_repeats(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [(0, 0), (0, 7), (7, 7), (7, 7), (8, 8)]


def test_tiles_lose_no_link(spark, monkeypatch):
    """Fingerprints a few bits apart, many of them in one tile that is cut into chunks."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    fps = {int(s) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), replace=False)) for s in seeds for _ in range(12)}
    fps |= {((1 << 40) - 1) ^ (1 << i) ^ (1 << 44 + j) for i in range(12) for j in range(12)} | {0, -1}
    df = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(df).collect()]
    whole = sorted(r["fp"] for r in df.collect())
    mask = (1 << 64) - 1
    wanted = [(a, b) for i, a in enumerate(whole) for b in whole[:i] if ((a ^ b) & mask).bit_count() <= 3]
    assert brute.components(whole, links) == brute.components(whole, wanted)
    assert all(a != b for a, b in links)


def plain_similar(docs, width=5, at_least=0.8):
    """The smallest id that Jaccard links of all pairs reach, by document."""
    words = {d: brute.lower_words(t) for d, t in docs.items()}
    sets = {d: {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set() for d, w in words.items()}
    ids = sorted(docs)
    near = lambda a, b: a == b or len(a & b) >= at_least * len(a | b) - 1e-9
    return brute.components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if near(sets[a], sets[b])])


@pytest.mark.parametrize("chunk", [4096, 8])
def test_pipeline_takes_similar_documents(spark, monkeypatch, chunk):
    """Near copies at many distances, chains of them, and a dense group, from five words at 0.8."""
    import corpus_pipeline

    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]
    docs, texts = {}, []
    for _ in range(12):
        words = word(300)
        texts.append(list(words))
        for _ in range(4):  # a chain: each a few words from the one before
            words = list(words)
            for at in rng.integers(0, 300, rng.integers(1, 7)):
                words[at] = word(1)[0]
            texts.append(words)
    dense = word(200)
    texts += [[*dense, *word(1)] for _ in range(30)] + [[*dense[:170], *word(30)] for _ in range(4)]
    docs = {i: " ".join(texts[j]) for i, j in enumerate(rng.permutation(len(texts)))}
    docs |= {900: "", 901: None, 902: "two words", 903: "Two  WORDS"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    groups = by_id(simhash.near_duplicates(df, **corpus_pipeline.SIMILAR), "component_id")
    wanted = plain_similar(docs)
    assert {d: c for d, (c,) in groups.items()} == wanted
    kept = corpus_pipeline.drop_near_duplicates(spark, df, SF)
    assert {r["doc_id"] for r in kept.collect()} == set(wanted.values())
    assert simhash.near_duplicates(df.where("doc_id < 0"), **corpus_pipeline.SIMILAR).count() == 0
    odd = simhash.near_duplicates(nulls_and_repeats(spark), **corpus_pipeline.SIMILAR).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in odd) == [(0, 0), (0, 7), (7, 7), (7, 7), (8, 8)]


def test_bitmaps_lose_no_link():
    """Sets around 0.8: bitmaps never differ in more bits than the sets do in hashes, and every
    pair that is alike stays a candidate."""
    rng = np.random.default_rng(4)
    rows, sets = [], []
    for n in (1, 2, 9, 40, 300, 5000):
        whole = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        for cut in (0, 0.05, 0.1, 0.11, 0.12, 0.25, 0.5):
            sets.append(np.unique(whole[int(cut * n) : int(cut * n) + n]))
            rows.append([len(rows), 0, len(sets[-1]), len(rows), *np.frombuffer(simhash.bitmap(sets[-1]), dtype=np.int64)])
    table = np.array(rows, dtype=np.int64).T.copy()
    left = simhash._close(table, table, 20, 0.8) < 65
    words = table[4:].view(np.uint64)
    dropped = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            differ = len(np.setxor1d(a, b))
            assert np.bitwise_count(words[:, i] ^ words[:, j]).sum() <= differ
            either = len(np.union1d(a, b))
            if i != j and either - differ >= 0.8 * either - 1e-9:
                assert left[i, j]
            dropped += i != j and not left[i, j]
    assert dropped > len(sets)
    found, other, _ = simhash._small_pairs(table[:, :40], np.zeros(40, dtype=int), 20, 0.8)
    assert {(i, j) for i in range(40) for j in range(i + 1, 40) if left[i, j]} == set(zip(found.tolist(), other.tolist(), strict=True))


# --- vectors ----------------------------------------------------------------------------------------


def vector_rows():
    rng = np.random.default_rng(9)
    rows, i = [], 0
    for c in range(40):
        centre = rng.normal(size=16)
        for spread in (0, 0, 0.02, 0.05, 0.08, 0.1):
            rows.append((i, (centre + spread * rng.normal(size=16) * 2).astype(np.float32).tolist(), c % 3))
            i += 1
    rows += [(i, None, 1), (i + 1, [0.0] * 16, 1), (i + 2, [1.0, None] * 8, 1), (i + 3, [float("nan")] * 16, 1)]
    return rows + [(i + 4, rows[0][1], None), (i + 5, [], 1), (i + 6, [float("inf")] * 16, 1), (i + 7, [1.0] * 3, 1), (i + 8, [2.0] * 3, 1)]


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 8)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, links string")
    columns = ("n_links", "component_id", "kept")
    sure = vectors.Plan(lines=64, recall=0.999999)
    assert by_id(vectors.near_vectors(df, sure), *columns, key="vec_id") == brute.near_vectors(rows)
    found = by_id(vectors.near_vectors(df), *columns, key="vec_id")
    wanted = brute.near_vectors(rows)
    links = lambda x: sum(n for n, _, _ in x.values())
    assert 0.97 * links(wanted) <= links(found) <= links(wanted)
    assert vectors.near_vectors(df.where("vec_id < 0")).count() == 0
    repeated = spark.createDataFrame([(None, [1.0], 1), (3, [1.0], 1), (3, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((r["n_links"], r["component_id"]) for r in vectors.near_vectors(repeated).collect()) == [(2, 3)] * 3


def test_recall_on_the_table(spark):
    rows = connect("/root/testdata/sf0.01").execute("select vec_id, embedding, label from embeddings").fetchall()
    found = by_id(queries.op7_near_vectors(spark, "/root/testdata/sf0.01"), "n_links", key="vec_id")
    wanted = brute.near_vectors(rows)
    total = sum(n for n, _, _ in wanted.values())
    assert 0.95 * total <= sum(n for (n,) in found.values()) <= total


# --- packing ---------------------------------------------------------------------------------------


def test_packing(spark, edges, empty, small, monkeypatch):
    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    for length in (2048, 64):
        pieces = packing.digest(packing.pack(edges, path, length=length)).collect()
        brute.check_packing([p.asDict() for p in pieces], brute.packed_ids(EDGES, path), length)
    pieces = queries.op8_packing(spark, SF).collect()
    brute.check_packing([p.asDict() for p in pieces], brute.packed_ids(small, path))
    assert packing.pack(empty, path).count() == 0
    near = sorted(map(tuple, packing.digest(packing.pack(edges, path)).collect()))
    with monkeypatch.context() as m:
        m.setattr(packing, "SENT", 0)
        assert sorted(map(tuple, packing.digest(packing.pack(edges, path)).collect())) == near
    assert sum(p["length"] for p in packing.pack(nulls_and_repeats(spark).withColumn("source", lit(None)), path).collect()) > 0


def test_words_are_encoded_as_in_their_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    odd = "It's don'TS 'story a.b,C x\x1cy É.É e\u0301x I\u0307z K ΑΣ ΑΣ. ΑΣx ſt ﬁ—. -—- 12ab3 <|endoftext|>, a'll'll \u00a0b\u2003c ñ"
    found = list(packing.WordIds(open(path, encoding="utf-8").read()).encode([odd, odd.upper(), ""]))
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in (odd, odd.upper(), "")]
    assert [np.frombuffer(x, dtype=np.uint16).tolist() for x in found] == wanted


def test_windows_have_the_target_mixture(spark):
    docs = connect(SF).execute("select doc_id, source from documents").fetchall()
    source = dict(docs)
    pieces = [p.asDict() for p in queries.op8_packing(spark, SF).collect()]
    totals, by_window = {}, {}
    for p in pieces:
        s = source[p["doc_id"]]
        totals[s] = totals.get(s, 0) + p["length"]
        by_window.setdefault(p["sequence_id"], {}).setdefault(s, 0)
        by_window[p["sequence_id"]][s] += p["length"]
    whole = sum(totals.values())
    for parts in list(by_window.values()):
        if sum(parts.values()) == 2048:
            assert all(abs(parts.get(s, 0) - 2048 * n / whole) <= 2 for s, n in totals.items())


def test_allotment_with_weights():
    a = packing.Allotment(np.array([1000, 300, 5000, 1]), np.array([1.0, 1.0, 1.0, 0.5]), 64)
    given = a.before(np.arange(a.windows + 1))
    assert (given.sum(axis=1) == np.minimum(np.arange(a.windows + 1) * 64, 6301)).all()
    assert (np.diff(given, axis=0) >= 0).all() and given[-1].tolist() == [1000, 300, 5000, 1]
    early = np.diff(given, axis=0)[:10]
    assert (np.abs(early[:, :3] - 64 / 3) <= 2).all()


# --- suffixes ---------------------------------------------------------------------------------------


def removed(df):
    return by_id(suffixes.digest(suffixes.remove_repeats(df)), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffixes(spark, edges, empty, small):
    assert removed(edges) == brute.suffix_dedup(EDGES)
    found = by_id(queries.op9_suffix_dedup(spark, SF), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.suffix_dedup(small)
    assert suffixes.remove_repeats(empty).count() == 0
    done = suffixes.remove_repeats(nulls_and_repeats(spark)).collect()
    size = len(PASSAGE.encode())
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in done) == [(0, 0), (0, size), (7, size), (7, size), (8, 0)]


def test_crowds_and_small_sorts_agree(spark, monkeypatch):
    """Passages with different surroundings, through digests and through small sorts."""
    rng = np.random.default_rng(2)
    text = lambda n: "".join(rng.choice(list("abcd "), n))
    shared = [text(260), text(400)]
    docs = {i: text(int(rng.integers(0, 300))) + shared[i % 2][: int(rng.integers(150, 400))] + text(150) for i in range(80)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    wanted = brute.suffix_dedup(docs)
    assert sum(n for _, n, _, _ in wanted.values()) > 5000
    assert removed(df) == wanted
    for name, value in (("CROWD", 3), ("SORTED", 2000), ("CROWD", 0)):
        monkeypatch.setattr(suffixes, name, value)
        assert removed(df) == wanted


def test_suffix_order():
    rng = np.random.default_rng(4)
    for letters in (b"ab", b"a", bytes(range(256))):
        flat = rng.choice(np.frombuffer(letters, dtype=np.uint8), 700)
        data = flat.tobytes()
        order = suffixes.suffix_order(flat, 704)
        assert order.tolist() == sorted(range(700), key=lambda i: data[i:])


# --- quality -----------------------------------------------------------------------------------------


def test_quality(spark, edges, empty):
    columns = (*quality.MEASURES, "base_failed")
    assert by_id(quality.verdicts(quality.ledger(edges)), *columns) == {d: brute.quality(t) for d, t in EDGES.items()}
    assert quality.ledger(empty).count() == 0 and quality.ledger(nulls_and_repeats(spark)).count() == 5


def test_ablations(spark):
    ledger = quality.ledger(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    rows = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality.ablations(ledger, "standard-1").collect()}
    assert set(rows) == set(quality.POLICIES["standard-1"])
    for rule, (failed, only) in rows.items():
        rest = [r for r in quality.POLICIES["standard-1"] if r != rule]
        assert failed == ledger.where(~quality.passes([rule])).count()
        assert only == ledger.where(quality.passes(rest) & ~quality.passes([rule])).count()
    bad = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id")
    good = quality.verdicts(quality.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).join(bad, "doc_id")
    assert good.where("not kept and not base_failed").count() == 0


# --- SQL ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equal_to_sql(spark, name):
    found = queries.QUERIES[name](spark, SF).toPandas()
    assert differences(found, connect(SF).execute(queries.ORACLES[name]).fetchdf()) == []


def test_pipeline_stages_keep_odd_columns_and_rows(spark):
    import corpus_pipeline

    rows = [(d, t, "en", "s", len(t or ""), 77, "x") for d, t in EDGES.items()]
    rows += [(30, PASSAGE, "en", "s", 1, 5, "y"), (30, PASSAGE, "en", "s", 1, 5, "y"), (None, "some words alone", None, None, None, 6, "z")]
    names = ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "__x"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines long, `__x` string").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == names, name
        got = out.collect()
        assert {r["n_lines"] for r in got if r["doc_id"] and r["doc_id"] < 30} <= {77} and all(r["__x"] in "xyz" for r in got), name
        assert stage(spark, df.where("false"), SF).count() == 0, name
        if name == "simhash_near_dedup":
            ids = [r["doc_id"] for r in got]
            assert ids.count(30) <= 1 and None in ids
            assert ids.count(8) + ids.count(9) + ids.count(30) >= 1
        elif name in ("line_dedup", "suffix_array_dedup"):
            assert len(got) == len(rows)
    packed = corpus_pipeline.pack(spark, df, SF)
    assert packed.count() > 0


def test_pipeline_of_a_whole_table(spark):
    """Every stage after the classifier against its plain version, on what came before it."""
    import corpus_pipeline

    docs = queries.table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).persist()
        before, kept = kept, {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        if name == "line_dedup":
            assert {d: brute.sha(t) for d, t in kept.items()} == {d: x[2] for d, x in brute.line_dedup(before).items()}
        elif name == "simhash_near_dedup":
            groups = plain_similar(before)
            assert set(kept) == set(groups.values())
            assert all(before[d] == t for d, t in kept.items())
        elif name == "suffix_array_dedup":
            plain = brute.suffix_dedup(before)
            assert {d: len(t.encode()) for d, t in kept.items()} == {d: x[0] - x[1] for d, x in plain.items()}
    ids = brute.packed_ids(kept, public_tokenizers.path(queries.WORD_TOKENIZER))
    brute.check_packing([r.asDict() for r in corpus_pipeline.pack(spark, docs, SF).collect()], ids)
    assert 0 < len(kept) < 200


def test_toxicity_training_takes_few_bytes_a_feature():
    import tracemalloc

    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**32, 5000)
    words = [np.unique(rng.choice(pool, 400)) for _ in range(500)]
    others = [w if i % 2 else None for i, w in enumerate(words)]
    tracemalloc.start()
    model = toxicity.fit(words, others, np.arange(500) % 3 == 0, toxicity.Settings(steps=3))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.trained and most < 38 * sum(map(len, words))  # 45 with eight bytes for each number


def test_texts_are_encoded_in_batches_of_the_rows_asked_for(spark, edges, monkeypatch):
    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, held = spark.conf.get(name), packing.hold
    monkeypatch.setattr(packing, "hold", lambda df: seen.append(spark.conf.get(name)) or held(df))
    brute.check_packing(
        [p.asDict() for p in packing.digest(packing.pack(edges, path, rows_at_once=2)).collect()], brute.packed_ids(EDGES, path)
    )
    assert seen == ["2"] and spark.conf.get(name) == before


def test_a_word_is_remembered_once():
    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    encoder = packing.WordIds(open(path, encoding="utf-8").read())
    assert list(encoder.encode(["abc abc. x abc", "abc"])) == list(encoder.encode(["abc abc. x abc", "abc"]))
    assert sum(len(kept) for kept in vars(encoder).values() if isinstance(kept, dict) and b"abc" in kept) == 3


def test_a_block_looks_up_each_different_word_once_and_keeps_blanks_out():
    from tokenizers import Tokenizer

    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

        def get(self, word, default=None):
            self.asked += 1
            return super().get(word, default)

    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    whole = Tokenizer.from_file(path)
    encoder = packing.WordIds(open(path, encoding="utf-8").read())
    encoder.known = known = Counted()
    blanks = "\x0b a\t\tb\r\n\x0c  A'LL c\x00d e\x1cf g\x85h i j àíß, "
    texts = ["", " \n", "<|endoftext|> a", *["the words, the words again. " * 100] * 20, blanks, blanks * 2, "\U0001f600 ﻿x"]
    found = [np.frombuffer(x, dtype=np.uint16).tolist() for x in encoder.encode(texts)]
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(encoder.encode([])) == []
    assert known.asked < 150 < 10_000 == sum(len(t.split()) for t in texts[3:23])
