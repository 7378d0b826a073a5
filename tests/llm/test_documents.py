"""The document operators against plain Python, and on awkward rows."""

import math
import pickle
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagestream.llm import decontaminate as dc
from pagestream.llm import jaccard, langid, linededup, mix, quality, shard, textscan, toxicity
from pagestream.llm.components import connected_components

import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t", "en", None, 3), (4, "one two three four five six seven eight nine ten eleven", "en", "s", 50), (4, "one two three four five six seven eight nine ten eleven", "en", "s", 50),
    (5, "one two three four five six seven eight nine ten eleven", None, "t", 50), (None, "null id here with words", "en", "s", 1), (6, "Ünïcode wörds ÀÉ été ñandú", "fr", "t", 9), (7, "word " * 60_000, "en", "s", 1), (8, "!!! ### 123", "de", None, 5),
]


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    for name in ("shard", "slot", "taken", "size", "key", "score", "kept", "n_words", "cls", "bucket", "hit_spans", "root", "word"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(n=60, seed=3):
    r = random.Random(seed)
    vocab = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta7", "eta", "theta", "iota", "kappa"]
    base = [" ".join(r.choice(vocab) + str(r.randint(0, 30)) for _ in range(r.choice([1, 2, 3, 5, 20, 60, 120]))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        w = r.choice(base).split(" ")
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            w[r.randrange(len(w))] = r.choice(vocab)
        out.append((i, r.choice([" ", "\n", "  "]).join(w)))
    return out


def test_hashes_follow_the_bytes():
    a, b = textscan.Slice.of(["Abc  déf", None, "x"]), textscan.Slice.of(["x déf", "aBC"])
    wa, wb = a.words(textscan.SPACED, fold=True), b.words(textscan.SPACED, fold=True)
    assert wa.count.tolist() == [2, 0, 1]
    assert wa.hash[0] == wb.hash[2]
    assert wa.hash[1] == wb.hash[1]
    assert wa.hash[2] == wb.hash[0] != wa.hash[0]


def test_decontamination_is_exact(spark, monkeypatch):
    r = random.Random(1)
    items = [(i, " ".join(f"w{r.randint(0, 40)}" for _ in range(n))) for i, n in enumerate([1, 2, 5, 9, 10, 11, 30, 0])] + [(3, "another one entirely")]
    docs = []
    for i in range(80):
        w = [f"W{r.randint(0, 40)}" for _ in range(r.choice([0, 1, 8, 50, 300]))]
        if i % 3 == 0:
            at = r.randint(0, len(w))
            w[at:at] = items[r.randrange(len(items))][1].split(" ")
        docs.append((i, "-".join(w)))
    expected = brute.contamination(docs, [(str(i), t) for i, t in items])
    for limit, part in ((dc.BLOCK_BYTES, dc.ITEM_BYTES), (60, 20), (dc.BLOCK_BYTES, 20)):  # one pass, several chained passes, several slices
        monkeypatch.setattr(dc, "BLOCK_BYTES", limit)
        monkeypatch.setattr(dc, "ITEM_BYTES", part)
        found = dc.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
        got = {r["doc_id"]: (r["n_words"], r["n"], r["hit_items"]) for r in found.withColumn("n", dc.hit_words()).collect()}
        assert got == expected


def test_jaccard_is_exact(spark, monkeypatch):
    docs = texts(150)
    # whole components in a chunk; small chunks and blocks; components divided by shingles
    for k, num, limit, sets in ((3, 90, jaccard.COMPONENT_SHINGLES, 4096), (5, 80, 150, 4096), (2, 50, 600, 3), (3, 90, 150, 2)):
        for name in ("REST_SETS", "MAIN_SETS", "CHUNK_SETS"):
            monkeypatch.setattr(jaccard, name, sets)
        found = jaccard.jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string"), k, num, 100, component_shingles=limit)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute.groups(docs, k, num, 100)


def test_patterns_are_compact():
    """About three times the items' bytes, besides a shift table of 4 MB at most."""
    r = random.Random(5)
    items = [(str(i), " ".join(f"w{r.randrange(10**6)}" for _ in range(1000))) for i in range(520)]
    size = sum(len(t) for _, t in items)
    assert size > 4e6
    patterns = dc.Patterns(iter(items), 10)
    assert len(pickle.dumps(patterns)) < 3.5 * size + (4 << 20)
    w = textscan.Slice.of(["x " + items[7][1] + " y"])
    hits = {i for group in patterns.groups for _, i in group.find(w.words(textscan.ALNUM, fold=True), w.folded().tobytes(), patterns.text)}
    assert hits == {7}


def short_sets(n):
    """Texts of 12 three-word shingles, of which three are in all of them and the others in none besides."""
    return ["the five words of all " + " ".join(f"w{i}x{j}" for j in range(9)) for i in range(n)]


def test_sets_that_share_signatures_take_linear_time():
    def seconds(n):
        sets = jaccard._Sets(pa.array(short_sets(n)), 3)
        began = time.process_time()
        assert len(set(jaccard._linked_groups(sets, 90, 100).tolist())) == n
        return time.process_time() - began

    small, large = seconds(2500), seconds(20_000)
    assert large < 24 * max(small, 0.02)  # pairs would take 64 times as long


def test_many_sets_that_share_signatures(spark):
    docs = spark.createDataFrame(list(enumerate(short_sets(20_000))), "doc_id long, text string").repartition(4)
    found = jaccard.jaccard_groups(docs, 3, 90, 100)
    assert found.where("component_id = doc_id and n_shingles = 12").count() == 20_000


def test_families_are_dealt_in_chunks(spark):
    r = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    docs = []
    for i in range(1500):
        words = list(base)
        words[r.randrange(100)] = f"x{i}"
        docs.append((i, " ".join(words)))
    found = jaccard.jaccard_groups(spark.createDataFrame(docs, "doc_id long, text string"), 3, 90, 100).collect()
    assert {r["component_id"] for r in found} == {0}
    with pytest.raises(TypeError):
        jaccard.jaccard_groups(spark.createDataFrame([("a", "b")], "doc_id string, text string"), 3, 90, 100)


def test_every_candidate_meets_its_neighbours(spark):
    """A class that heads a signature but is no centre is compared in its neighbour's chunk."""
    base = [f"w{i}" for i in range(60)]
    texts_of = {1: "other words than these", 2: " ".join(base), 3: " ".join([*base, "more"])}
    docs = spark.createDataFrame([(i, i, t) for i, t in texts_of.items()], f"id_key long, text_key long, {textscan.TEXT} string")
    reps = spark.createDataFrame([(i, 1, len(t.split()) - 2, i, i) for i, t in texts_of.items()], "cls long, root long, n long, r_id long, r_key long")
    near = spark.createDataFrame([(3, 1), (3, 2)], "a long, b long")
    links, chunks = jaccard._Search(docs, reps, 3, 3, 90, 100, 1000).in_chunks(near)
    roots = {r["v"]: r["root"] for r in connected_components(links).collect()}
    assert roots[2] == roots[3]
    assert chunks.count() == 1


def test_one_of_each_group_stays(spark):
    docs = texts(90)
    expected = {g for d, (n, g) in brute.groups(docs, 5, 80, 100).items()}
    left = jaccard.keep_first(spark.createDataFrame(docs + docs[:7], "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(expected)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    for one_task in (1000, 0):  # in one task, and in rounds
        got = {r["v"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), one_task).collect()}
        assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


def test_counts_are_exact(spark):
    r = random.Random(2)
    docs = [(i, "\n".join(" ".join(r.choice(["a", "bé", "c#", "d|"]) for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 12)))) for i in range(60)]
    got = quality.text_counts(spark.createDataFrame(docs, "doc_id long, text string"), ["doc_id"]).collect()
    assert {x["doc_id"]: tuple(x[c] for c in quality.BASE) for x in got} == {d: brute.base_counts(t) for d, t in docs}


def test_cutoffs_adapt(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "gamma"]) + str(r.randint(0, 99)) for _ in range(60)), "en", f"s{i % 2}", 0) for i in range(200)]
    rows += [(1000 + i, " ".join("w%d### %%%%" % r.randint(0, 999) for _ in range(60)), "en", "s0", 0) for i in range(6)]
    got = {x["doc_id"]: x["kept"] for x in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] for i in range(200))
    assert not any(got[1000 + i] for i in range(6))


def test_targets_fill_up(spark):
    r = random.Random(5)
    docs = [(i, " ".join(["w"] * r.randint(0, 50)), "en", r.choice(["a", "b", "b", "b", "c", "d", None]), 0) for i in range(300)]
    got = mix.mix_sources(spark.createDataFrame(docs, SCHEMA)).collect()
    sizes = {}
    for _, t, _, s, _ in docs:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    targets = brute.fill(sizes, (5, 2, 1), 1.5, 2)
    assert len(got) == 300
    for s in sizes:
        rows = [x for x in got if x["source"] == s]
        assert rows[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(x["taken"] for x in rows) - targets[s]) <= 0.5 + 1e-6
    assert all(0 <= x["taken"] <= 2 * x["size"] for x in got)
    again = mix.mix_sources(spark.createDataFrame(docs, SCHEMA).repartition(7)).collect()
    assert sorted(again) == sorted(got)
    mixed = mix.repeat_taken(spark.createDataFrame(docs, SCHEMA)).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w")))).collect()
    assert all(abs(n - targets[s]) <= 50 for s, n in mixed)


def test_shards_are_a_permutation(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 10).alias("text"))
    got = shard.assign_shards(docs, 7, bucket_bytes=500).collect()
    assert sorted(x["doc_id"] for x in got) == list(range(1000))
    for k in range(7):
        slots = sorted(x["slot"] for x in got if x["shard"] == k)
        assert slots == list(range(len(slots)))
        assert len(slots) in (142, 143)
    again = shard.assign_shards(docs.repartition(5), 7, bucket_bytes=500).collect()
    assert sorted(got) == sorted(again)
    assert [x["doc_id"] for x in sorted(got, key=lambda x: (x["shard"], x["slot"]))][:20] != list(range(20))


def test_places_match_plain_fisher_yates(spark):
    rows = [(i, f"text {i % 37}", "s") for i in range(400)] + [(None, "n", "s"), (5, None, "s"), (None, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limit, shards = 700, 5
    size = lambda t: len((t or "").encode()) + 1
    buckets = -(-sum(size(t) for _, t, _ in rows) // limit)
    key = F.xxhash64(F.lit(shard.SEED), "doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())
    keyed = [(r["k"] % buckets, r["k"], (r["doc_id"], r["text"])) for r in docs.select("doc_id", "text", key.alias("k")).collect()]
    order = []
    for b in range(buckets):
        inside = sorted((x for x in keyed if x[0] == b), key=lambda x: x[1])
        perm = np.random.Generator(np.random.PCG64([shard.SEED, b])).permutation(len(inside))
        order += [row for _, row in sorted(zip(perm.tolist(), [x[2] for x in inside], strict=True), key=lambda x: x[0])]
    sizes = [len(rows) // shards + (k < len(rows) % shards) for k in range(shards)]
    bounds = np.cumsum([0, *sizes])
    expected = {row: (k, i) for k in range(shards) for i, row in enumerate(order[bounds[k] : bounds[k + 1]])}
    got = {(r["doc_id"], r["text"]): (r["shard"], r["slot"]) for r in shard.assign_shards(docs, shards, bucket_bytes=limit).collect()}
    assert got == expected


def test_copies_are_dealt_over_buckets(spark):
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text in all of them").alias("text"), F.lit("s").alias("source"))
    rows = rows.unionAll(spark.range(500).select("id", F.concat(F.lit("t"), "id"), F.lit("s")))
    placed = shard.assign_shards(rows, 4, bucket_bytes=50_000)
    partition = placed.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert max(r["count"] for r in partition) < 0.5 * 20_500
    got = placed.collect()
    assert len(got) == 20_500
    for k in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(5125))


def test_nothing_is_left_behind(spark, sf):
    from pathlib import Path

    from pagestream.llm import common
    from pagestream.llm import queries as q

    for name in ("op7_line_dedup", "op8_shard", "op9_quality"):
        q.queries()[name](spark, sf).count()
    common.released(spark)
    left = [p for p in Path(common.shared_folder(spark)).iterdir() if p.name.startswith(("lines", "gone"))]
    assert not left
    assert not common._tables
    assert not common._kept


def test_written_shards_come_back(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    shard.write_shards(docs, str(tmp_path / "s"), 3)
    assert sorted(r["doc_id"] for r in spark.read.parquet(str(tmp_path / "s")).collect()) == list(range(100))


def test_templates_drop_recurring_lines(spark):
    docs = [(i, f"Posted by user{i} on day {i}\nown line number words{'abc'[i % 3]} x{i}y{i} unlike any other {'q' * i}\nok") for i in range(5)]
    got = {r["doc_id"]: r for r in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all("Posted" not in r["text"] and r["text"].endswith("ok") for r in got.values())
    copies = spark.createDataFrame([(i, "the very same text in all rows\nsecond line of the text") for i in range(9)], "doc_id long, text string")
    assert all(r["n_dropped"] == 0 for r in linededup.dedup_lines(copies).collect())


def test_linked_short_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for _ in range(4):
        base = rng.integers(0, 1 << 52, (400, 5), dtype=np.uint64)
        h = np.concatenate([np.concatenate([row, row[:4]]) for row in base])  # 4 of 5 shingles in common
        doc = np.repeat(np.arange(800), np.tile([5, 4], 400))
        sig, owner, _ = jaccard._signatures(doc, h, np.bincount(doc), 80, 100, jaccard.Frequent(np.zeros(0, dtype=np.uint64)))
        have = [set(sig[owner == d].tolist()) for d in range(800)]
        assert all(have[d] & have[d + 1] for d in range(0, 800, 2))


def test_long_leaves_and_clashing_columns(spark):
    long = " ".join(f"token{i}" for i in range(20_000))
    docs = [(i, f"same three lead {long} {'abcdef'[i]}\nown {'q' * i} words of this text", "x") for i in range(6)]
    found = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, n_lines string").withColumn("n_dropped", F.lit("clash")).withColumn("key", F.lit(1)))
    assert found.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    assert all(r["n_dropped"] == 1 and r["n_lines"] == 2 and r["text"].startswith("own") for r in found.collect())


def test_short_lines_recur(spark):
    docs = [(i, f"only text {'abcdef'[i]} says this {'q' * i}\n\nAll rights  reserved.\nPage {i}\n{'rare' if i < 3 else 'r' * i}") for i in range(6)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in linededup.dedup_lines(docs, short_texts=5).collect()}
    assert all("reserved" not in r["text"] and "Page" not in r["text"] and r["n_dropped"] == 2 for r in got.values())
    assert all("\n\n" in r["text"] and "says this" in r["text"] for r in got.values())
    assert got[0]["text"].endswith("rare")


def test_long_passages_recur_in_two_texts(spark):
    passage, other = " ".join(f"word{'abcdefgh'[i % 8]}{'q' * i}" for i in range(51)), " ".join(f"term{'q' * i}" for i in range(50))
    docs = [(1, f"own words {'x' * 5} of one\n{passage}"), (2, f"{passage}\nother words {'y' * 5} of two"), (3, f"{other}\nthree is alone"), (4, f"{other}\nfour stays too"), (5, f"own words {'x' * 5} of one\n{passage}")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}
    assert got[1] == got[5] == f"own words {'x' * 5} of one" and got[2] == f"other words {'y' * 5} of two"  # 51 words in two texts go
    assert got[3].startswith(other) and got[4].startswith(other)  # 50 words need MIN_TEXTS
    assert all("wordaq" not in r["text"] or r["n_dropped"] == 0 for r in linededup.dedup_lines(docs, long_texts=3).collect())
    copies = docs.where("doc_id in (1, 5)")
    assert all(r["n_dropped"] == 0 for r in linededup.dedup_lines(copies).collect())  # copies are one text


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = langid.held_out(F.col("doc_id"), 4, 2)
    found = langid.identify(docs.where(held), langid.train(docs.where(~held)), ["doc_id", "lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.9


def invented(n, seed=1):
    """n languages, each with words of its own."""
    r = random.Random(seed)
    return {f"l{i:03}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 6))) for _ in range(30)] for i in range(n)}


def test_every_language_is_learned(spark):
    r, languages = random.Random(2), invented(300)
    text = lambda k: " ".join(r.choice(languages[k]) for _ in range(60))
    # the last language has one row, the others more
    rows = [(1000 * i + j, text(k), k) for i, k in enumerate(languages) for j in range(1 if k == "l299" else 4)]
    docs = spark.createDataFrame([(i, text(k), k) for i, k in enumerate(languages)], "doc_id long, text string, lang string")
    for bound in (8192, 300):
        model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=bound)
        assert sorted(model.languages) == sorted(languages)
        got = {x["lang"]: x["lang_pred"] for x in langid.identify(docs, model, ["lang"]).collect()}
        assert got["l299"] == "l299"
        assert np.mean([k == v for k, v in got.items()]) > 0.97


def test_counts_and_likelihoods_match_plain_python(spark):
    rows = [(1, "Abab abba", "x"), (2, "bab é", "x"), (3, "zzz zz", "y"), (4, "a", "y"), (5, "", "y")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = {k: {} for k in model.languages}
    for _, text, lang in rows:
        b = brute.fold(text).encode()
        for i in range(len(b) - 2):
            g = int.from_bytes(b[i : i + 3], "big") * 2654435761 % 2**32 >> 32 - langid.GRAM_BITS
            counts[lang][g] = counts[lang].get(g, 0) + 1
    seen = sorted(set().union(*counts.values()))
    assert np.flatnonzero(model.code).tolist() == seen
    for k, lang in enumerate(model.languages):
        whole = sum(counts[lang].values()) + 0.1 * 2**langid.GRAM_BITS
        for c in set(model.code[seen].tolist()):
            assert model.p[c, k] == pytest.approx(sum((counts[lang].get(g, 0) + 0.1) / whole for g in seen if model.code[g] == c), rel=1e-6)
        assert model.unseen[k] == pytest.approx((2**langid.GRAM_BITS - len(seen)) * 0.1 / whole)


def test_mixtures_match_plain_em():
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(6), size=3).T  # 6 codes, 3 languages
    counts = rng.integers(0, 9, (5, 6)).astype(float)
    share, likelihood = langid._em(counts, p, 7)
    for d in range(5):
        s = [1 / 3] * 3
        for _ in range(7):
            new = [0.0] * 3
            for c in range(6):
                mixed = sum(s[k] * p[c, k] for k in range(3))
                for k in range(3):
                    new[k] += counts[d, c] * s[k] * p[c, k] / mixed
            s = [x / sum(new) for x in new]
        assert share[d] == pytest.approx(s)
        assert likelihood[d] == pytest.approx(sum(counts[d, c] * np.log(sum(s[k] * p[c, k] for k in range(3))) for c in range(6)) / langid.OVERLAP)
    # the part of no language: two components, plain and mixture
    model = langid.Model(["a", "b", "c"], np.zeros(1, dtype=int), p, np.ones(3) / 3, p[0].copy(), rng.dirichlet(np.ones(6)))
    got = langid.background(counts, [[0]] * 4 + [[1, 2]], [[1.0]] * 4 + [[0.25, 0.75]], model, 9)
    for d in range(5):
        own = [p[c, 0] if d < 4 else 0.25 * p[c, 1] + 0.75 * p[c, 2] for c in range(6)]
        part = 0.5
        for _ in range(9):
            part = sum(counts[d, c] * part * model.plain[c] / (part * model.plain[c] + (1 - part) * own[c]) for c in range(6)) / counts[d].sum()
        assert got[d] == pytest.approx(part)


def test_language_mixture(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 300")
    model = langid.train(docs)
    one = {r["lang"]: r["text"] for r in docs.select("lang", "text").collect()}
    both = spark.createDataFrame([(1, one["en"] + " " + one["fr"]), (2, one["de"])], "doc_id long, text string")
    got = {r["doc_id"]: set(r["languages"]) for r in langid.identify(both, model, ["doc_id"]).collect()}
    assert got == {1: {"en", "fr"}, 2: {"de"}}


def test_toxicity_ranks(spark):
    r = random.Random(6)
    words = ["the", "and", "of", "day", "tree", "you", "stone"]
    rows = [(i, " ".join(r.choice(words + ["idiot", "grumblex"] * (i % 4 == 0)) for _ in range(50))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    held = langid.held_out(F.col("doc_id"), 3, 1)
    got = toxicity.score(docs, toxicity.train(docs, labels.where(~held)), ["doc_id"]).collect()
    assert np.mean([(x["doc_id"] % 4 == 0) == (x["predicted"] == 1) for x in got]) > 0.97


def plain_features(text, learned):
    """The dense features by plain Python; ``learned`` gives a word's weight."""
    raw = (text or "").encode()
    words = [(m[0], m.start()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", raw)]
    low = [w.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).decode(errors="replace") for w, _ in words]
    weight, abuse, second = [learned(w) for w in low], [w in toxicity.ABUSE for w in low], [w in toxicity.SECOND_PERSON for w in low]
    strong = [a or b > 0 for a, b in zip(abuse, weight, strict=True)]
    near = [s and any(second[j] for j in range(max(0, i - toxicity.NEAR), min(len(low), i + toxicity.NEAR + 1))) for i, s in enumerate(strong)]
    n, size = max(len(low), 1), max(len(raw), 1)
    count = lambda pattern: len(re.findall(pattern, raw))
    run = sum(raw[i] == raw[i - 1] == raw[i - 2] and chr(raw[i]).isascii() and chr(raw[i]).isalpha() for i in range(2, len(raw)))
    mixed = sum(bool(re.search(rb"[0-9]", w)) and len(re.findall(rb"[A-Za-z]", w)) > 1 for w, _ in words)
    return [
        math.log1p(len(low)), sum(abuse) / n, math.log1p(sum(abuse)), sum(weight) / n, max([0.0, *weight]), math.log1p(sum(x > 0 for x in weight)),
        sum(near) / max(sum(strong), 1), sum(second) / n, count(rb"[A-Z]") / max(count(rb"[A-Za-z]"), 1), sum(re.fullmatch(rb"[A-Z]{3,}", w) is not None for w, _ in words) / n,
        count(rb"!") / size, count(rb"\?") / size, count(rb"[#*$%&|<>@^~]") / size, mixed / n, run / size,
    ]


def test_features_match_plain_python():
    stem = toxicity.mix(textscan.Slice.of(["grum"]).words(textscan.ALNUM).hash + np.uint64(4 << 8)) >> np.uint64(12)
    word = toxicity.mix(textscan.Slice.of(["stone"]).words(textscan.ALNUM).hash + np.uint64(1)) >> np.uint64(12)
    lexicon = toxicity.Lexicon(np.concatenate([stem, word]), np.array([3.0, 2.5]))
    learned = lambda w: 3.0 if w.startswith("grum") and len(w) > 4 else 2.5 if w == "stone" else 0.0
    r = random.Random(9)
    vocab = ["the", "You", "YOUR", "idiot", "Grumble", "grum", "stone", "b4d", "soooo", "WHY??", "no!", "#@$", "tú", "ÀB", "x1", "u", "DUMB", "\n", "a b"]
    texts = [None, "", "!!!", "you"] + [" ".join(r.choice(vocab) for _ in range(r.randint(1, 60))) for _ in range(60)]
    got = toxicity.features(textscan.Slice.of(texts), lexicon)
    for text, row in zip(texts, got.tolist(), strict=True):
        assert row == pytest.approx(plain_features(text, learned)), text


def test_one_class_and_ties(spark):
    docs = spark.createDataFrame([(i, "the very same words") for i in range(40)], "doc_id long, text string")
    for label in (0, 1):
        labels = spark.createDataFrame([(i, label) for i in range(40)], "doc_id long, toxic int")
        scores = {r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels), ["doc_id"]).collect()}
        assert len(scores) == 1
        assert (scores.pop() >= 0.5) == (label == 1)
    s, p = toxicity.isotonic(np.zeros(10), np.arange(10) % 2.0)
    assert len(s) == len(p) == 1


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    assert np.mean((toxicity.Trees().fit(x, y).score(x) > 0) == (y > 0)) > 0.95
    s, p = toxicity.isotonic(rng.normal(size=200), rng.integers(0, 2, 200).astype(float))
    assert (np.diff(p) >= 0).all()
    assert (np.diff(s) > 0).all()


def test_awkward_rows_everywhere(spark, awkward):
    bench = spark.createDataFrame([(1, "two three four"), (None, "nine ten"), (2, None), (3, "")], "item_id long, text string")
    n = len(AWKWARD)
    found = dc.find_contamination(awkward, bench, ["doc_id"]).collect()
    assert len(found) == n
    assert {r["doc_id"]: r["hit_items"] for r in found}[5] == ["1"]
    assert dc.decontaminate(awkward, bench).columns == awkward.columns
    assert dc.decontaminate(awkward, bench).count() == n - 3
    groups = {r["doc_id"]: r for r in jaccard.jaccard_groups(awkward, 3, 90, 100).collect()}
    assert len(groups) == 9
    assert groups[5]["component_id"] == 4
    assert groups[7]["n_shingles"] == 1
    assert (groups[1]["n_shingles"], groups[1]["component_id"]) == (0, 1)
    left = jaccard.keep_first(awkward)
    assert left.columns == awkward.columns
    assert left.count() == n - 2
    judged = {r["doc_id"]: r for r in quality.judge(awkward).collect()}
    assert judged[1]["n_words"] == 0
    assert judged[1]["base_failed"]
    taken = mix.mix_sources(awkward).collect()
    assert len(taken) == n
    assert mix.repeat_taken(awkward).columns == awkward.columns
    placed = shard.assign_shards(awkward, 3)
    assert placed.count() == n
    assert placed.columns[-2:] == ["shard", "slot"]
    lines = {r["doc_id"]: r for r in linededup.dedup_lines(awkward).collect()}
    assert lines[1]["text"] is None
    assert lines[2]["text"] == ""
    assert lines[7]["text"] == AWKWARD[8][1]
    model = langid.train(awkward)
    langs = {r["doc_id"]: r for r in langid.identify(awkward, model, ["doc_id"]).collect()}
    assert langs[1]["lang_pred"] == langs[8]["lang_pred"] == "und"
    assert langs[6]["lang_pred"] == "fr"
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (99, 1), (None, 1), (8, None)], "doc_id long, toxic int")
    scored = toxicity.score(awkward, toxicity.train(awkward, labels), ["doc_id", "score"]).collect()
    assert len(scored) == n
    assert all(0 <= r["score"] <= 1 for r in scored)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(empty, bench, ["doc_id"]).count() == 0
    assert jaccard.jaccard_groups(empty, 3, 90, 100).count() == 0
    assert jaccard.keep_first(empty).count() == 0
    assert quality.judge(empty).count() == 0
    assert mix.mix_sources(empty).count() == 0
    assert mix.repeat_taken(empty).count() == 0
    assert shard.assign_shards(empty, 4).count() == 0
    assert linededup.dedup_lines(empty).count() == 0
    assert langid.train(empty) is None
    assert langid.identify(empty, None, ["doc_id"]).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, toxicity.train(empty, labels), ["doc_id"]).count() == 0
    some = spark.createDataFrame([(1, "words without any benchmark", "en", "s", 0)], SCHEMA)
    assert dc.decontaminate(some, bench).count() == 1
