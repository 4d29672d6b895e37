"""The queries on the small tables, and the pipeline stage by stage."""

import collections
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from annospark.lineage import cut
from annospark.llm import queries, simhash


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(same, name):
    same(queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_ten_operators_and_five_stages():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "x", 0), (None, "x y z", "en", "x", 5), (10**6 + 2, "password=abcdefghijkl", "en", "x", 21)], docs.schema)
    out, docs = [], docs.unionByName(extra).cache()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf).cache()
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_return_the_columns_of_documents(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)
    assert stages[-1][2].count() == stages[-1][1].count()


def test_filtering_stages_only_drop_rows(stages):
    for _, before, after in stages[:3]:
        kept, had = collections.Counter(map(tuple, after.collect())), collections.Counter(map(tuple, before.collect()))
        assert kept <= had and 0 < sum(kept.values())


def test_exact_stage_keeps_the_largest_id_of_each_text(stages):
    _, before, after = stages[1]
    best = {}
    for r in before.collect():
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")
        best[t] = max(best.get(t, -1), -1 if r["doc_id"] is None else r["doc_id"])
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in after.collect()) == sorted(best.values())


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_stage_leaves_no_close_pair_and_drops_no_lone_text(stages):
    _, before, after = stages[2]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before.collect()}
    likeness = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    kept = {r["doc_id"] for r in after.collect()}
    names = list(sets)
    best = {a: max(likeness(a, b) for b in names if b != a) for a in names}
    assert all(best[i] >= 0.8 for i in names if i not in kept)
    close = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if likeness(a, b) >= 0.85]
    assert not [p for p in close if set(p) <= kept]


def test_secrets_stage_keeps_rows_and_hides_secrets(stages):
    _, before, after = stages[3]
    was, now = ({r["doc_id"]: r for r in df.collect()} for df in (before, after))
    assert was.keys() == now.keys() and now[10**6 + 2]["text"] == "[assign]" and now[10**6 + 2]["n_chars"] == 8
    assert not after.where(F.col("text").rlike("[0-9a-f]{16}")).count() and all(now[i] == was[i] for i in was if "[" not in (now[i]["text"] or ""))


def test_toxicity_stage_drops_few(stages):
    _, before, after = stages[0]
    assert after.count() >= 0.8 * before.count()


def test_run(spark, sf):
    assert set(corpus_pipeline.run(spark, sf).columns) == {"doc_id", "n_tokens", "bucket", "padded", "batch", "slot"}


WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"]


def kept_of(spark, texts, **how):
    return {r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **how).collect()}


def least_of_classes(texts):
    """The least number of each class of links of Jaccard similarity 0.8, by all pairs."""
    sets, forest = [shingles(t) for t in texts], simhash._Forest()
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            forest.join(a, b)
    return {forest.root(i) for i in range(len(texts))}


@pytest.mark.parametrize("hot", [simhash.HOT, 16])
def test_near_stage_finds_every_pair_from_80_percent_up(spark, hot):
    rng = np.random.default_rng(11)
    texts = []
    for _ in range(120):
        w = rng.choice(WORDS, int(rng.integers(20, 300))).tolist()
        texts.append(" ".join(w))
        for k in (0.1, 0.105, 0.11, 0.115, 0.12):  # tails replaced: Jaccard 0.78 to 0.82
            texts.append(" ".join(w[: len(w) - int(k * len(w))] + rng.choice(WORDS, int(k * len(w))).tolist()))
    assert kept_of(spark, texts, hot=hot) == least_of_classes(texts)


def test_near_stage_keeps_different_texts_of_one_fingerprint(spark):
    rng = np.random.default_rng(12)
    line = "the same seven words in every text"
    texts = [" ".join([line] * 100 + rng.choice(WORDS, 300).tolist()) for _ in range(30)]
    assert len({tuple(simhash.fingerprint(t, 5, 4)) for t in texts}) < 30
    assert kept_of(spark, texts) == set(range(30))


def test_near_stage_joins_groups_of_copies_around_the_threshold(spark):
    rng = np.random.default_rng(13)
    texts = []
    for _ in range(100):  # six copies, each with 5 to 13 % of its shingles replaced
        w = rng.choice(WORDS, 200).tolist()
        for _ in range(6):
            copy = list(w)
            for at in rng.choice(200, int(rng.integers(2, 6)), replace=False):
                copy[at] = str(rng.choice(WORDS))
            texts.append(" ".join(copy))
    assert kept_of(spark, texts) == least_of_classes(texts)


def test_dedup_stages_decide_on_each_row(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (1, text), (1, "other words"), (None, text), (None, "alone"), (None, "alone"), (None, "ALONE"), (2, "b"), (2, "b"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for stage, blank in ((corpus_pipeline.exact, 1), (corpus_pipeline.near, 1)):
        got = collections.Counter((r["doc_id"], (r["text"] or "").lower()) for r in stage(spark, docs, None).collect())
        assert got == {(1, text): 1, (1, "other words"): 1, (None, "alone"): 1, (2, "b"): 1, (None, ""): blank}


def exchanged(df):
    """What each shuffle of a plan moves, as text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [block for block in plan.split("\n") if "Exchange" in block]


def test_rows_are_dropped_without_moving_texts(spark, monkeypatch):
    from annospark import skew
    from annospark.llm import keep

    rows = [(i if i % 5 else None, f"text {i // 2}", i) for i in range(400)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, own int").repartition(4)
    key = {"id": F.col("doc_id"), "k0": F.xxhash64("text"), "sha": F.unhex(F.sha2("text", 256))}
    each = docs.select(*(c.alias(k) for k, c in key.items()), "own").groupBy(*key).agg(F.min("own").alias("own"))
    gone = cut(each.where("own % 3 < 2").select(*key, (F.col("own") % 3 == 1).alias("stays")), "gone")
    by_join = sorted(map(tuple, keep.without(docs, key, gone).collect()), key=repr)
    monkeypatch.setattr(skew, "SENT_ROWS", 0)
    for most in (1 << 20, 10):  # by the cascade, and beyond its bound
        got = keep.without(docs, key, gone, most)
        assert sorted(map(tuple, got.select("doc_id", "text").collect()), key=repr) == sorted((r[:2] for r in by_join), key=repr)
    only = keep.without(docs, key, cut(gone.withColumn("stays", F.lit(False)), "gone"))
    assert 0 < only.count() < docs.count() and "Join" not in only._jdf.queryExecution().optimizedPlan().toString()


def test_near_stage_is_the_same_where_nothing_may_be_sent(spark, monkeypatch):
    from annospark import skew

    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(60):
        base = list(rng.choice(words, 60))
        texts += [" ".join(base), " ".join([*base[:58], *rng.choice(words, int(rng.integers(0, 5)))])]
    docs = spark.createDataFrame(list(enumerate([*texts, *texts[:5], None, ""])), "doc_id long, text string").repartition(3)
    want = {r["doc_id"] for r in simhash.near_dedup(docs).collect()}
    monkeypatch.setattr(skew, "SENT_ROWS", 0)
    assert {r["doc_id"] for r in simhash.near_dedup(docs).collect()} == want and 60 <= len(want) < 120


def test_crowds_count_all_shingles_and_order_common_ones_last(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD_BITS", 15)
    rng = np.random.default_rng(13)
    shared = " ".join(f"s{i}" for i in range(40))
    # One text in a hundred holds the passage, so few of any small sample of rows do.
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 60)) + (" " + shared if i % 100 == 0 else "") for i in range(3000)] + [None, ""]
    found = simhash.crowds(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), "text", 5)
    want = np.zeros(1 << 15, np.int64)
    for t in texts:
        np.add.at(want, (simhash.shingle_hashes(t, 5) >> np.uint64(49)).astype(np.int64), 1)
    assert (found == np.round(8 * np.log2(want + 1)).astype(np.uint16)).all()
    passage = set(simhash.shingle_hashes(shared, 5).tolist())
    heads = [set(simhash.head(np.unique(simhash.shingle_hashes(t, 5)), found, 0.8).tolist()) for t in texts[:1000:100]]
    assert sum(len(h & passage) for h in heads) <= 0.1 * sum(map(len, heads))


def near_copies(rng, n, words=150):
    """Copies of one text with one to four words replaced each: pairs on both sides of the threshold, most of them below it."""
    base = rng.choice(WORDS, words).tolist()
    out = []
    for _ in range(n):
        copy = list(base)
        for at in rng.choice(words, int(rng.integers(1, 5)), replace=False):
            copy[at] = str(rng.choice(WORDS))
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("hot, sent, per_group", [(simhash.HOT, None, None), (64, 0, 1 << 14)])
def test_near_stage_finds_the_classes_of_many_copies_around_the_threshold(spark, monkeypatch, hot, sent, per_group):
    from annospark import skew

    if sent is not None:
        monkeypatch.setattr(skew, "SENT_ROWS", sent)
        monkeypatch.setattr(simhash, "GROUP_SHINGLES", per_group)
    rng = np.random.default_rng(14)
    texts = near_copies(rng, 400) + near_copies(rng, 60, 24) + [" ".join(rng.choice(WORDS, 80)) for _ in range(40)]
    want = least_of_classes(texts)
    assert 60 < len(want) < 400 and kept_of(spark, texts, hot=hot) == want


def test_candidates_grow_with_the_nodes_of_a_group_not_with_its_pairs(spark):
    def made(nodes):
        table = spark.createDataFrame([(i, i, 10, [1, 2, 100 + i]) for i in range(nodes)], "node long, member long, n long, head array<long>")
        return simhash.candidates(table, 0.8).collect()

    assert len(made(20)) == 190  # all pairs
    rows = made(3000)  # beyond HOT: chunks that meet pairwise
    assert len(rows) <= 4 * 3000 and {r["v"] for r in rows if r["crowd"]} == set(range(3000))


def test_bitmaps_never_reject_a_pair():
    rng = np.random.default_rng(15)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.int64)
    sets = [np.unique(rng.choice(pool[:k], k // 2)) for k in (2, 40, 60, 400, 420, 3900, 4000) for _ in range(6)]
    rows = simhash.bitmaps(sets)
    for i, j in itertools.combinations(range(len(sets)), 2):
        assert np.bitwise_count(rows[i] ^ rows[j]).sum() <= len(set(sets[i].tolist()) ^ set(sets[j].tolist()))
