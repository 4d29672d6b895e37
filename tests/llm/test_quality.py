"""The quality classifier: passages word by word, slopes by finite differences, scores by plain sums, held-out accuracy."""

import zlib

import numpy as np
import pytest

from annospark.llm import quality, queries

TEXTS = [None, "", " \n ", "one", "Some words, here. " * 40, "lead " * 33, "\n\n  spaced   out\t\tTEXT 12 %% !!\n", "日本語 ÄÖ ß 😀 \x00 x", "w" * 5000, "A, b; c! " * 200]


def test_passages_do_not_depend_on_the_texts_around_them():
    texts = [t or "" for t in TEXTS]
    rows, count = quality.describe(texts)
    assert count.tolist() == [-(-len(t.split()) // quality.PASSAGE) for t in texts]
    alone = [quality.describe([t])[0] for t in texts]
    assert np.array_equal(rows, np.concatenate(alone))
    # Passages of a text are those of its words taken by themselves.
    words = TEXTS[9].split(" ")[:-1]
    again = [quality.describe([" ".join(words[i : i + quality.PASSAGE])])[0] for i in range(0, len(words), quality.PASSAGE)]
    assert np.allclose(alone[9], np.concatenate(again))


def test_numbers_of_a_passage_counted_by_hand():
    row = quality.describe(["Cat cat DOG 12 a-b. x\ncat!"])[0][0]
    kinds = dict(zip(quality.KINDS, row * 26, strict=False))
    assert [round(float(kinds[k])) for k in ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "other")] == [11, 4, 2, 5, 1, 2, 1, 0]
    singles = row[len(quality.KINDS) : quality.SINGLE]
    assert np.allclose(singles[2:11] * 7, [2, 0, 2, 1, 1, 1, 0, 1, 1]) and abs(singles[11] * 7 - 6) < 1e-5
    assert abs(np.exp(singles[0]) - 1 - 20 / 7) < 1e-4


def test_slopes_by_finite_differences():
    rng = np.random.default_rng(1)
    model = quality.train([rng.normal(size=(3, quality.SIZE)), rng.normal(size=(2, quality.SIZE))], np.array([0, 1]))
    model.weights = {k: (w + rng.normal(0, 0.3, w.shape)).astype(np.float64) for k, w in model.weights.items()}
    x, first, labels = rng.normal(size=(9, quality.SIZE)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    _, found = quality.slopes(model, x, first, labels)
    for name, w in model.weights.items():
        for k in rng.integers(0, w.size, 5):
            at, step = np.unravel_index(k, w.shape), 1e-5
            w[at] += step
            up, _ = quality.slopes(model, x, first, labels)
            w[at] -= 2 * step
            down, _ = quality.slopes(model, x, first, labels)
            w[at] += step
            assert abs((up - down) / (2 * step) - found[name][at]) < 1e-6


@pytest.fixture(scope="module")
def model(spark, sf):
    return quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_scores_are_attention_weighted_means_over_all_passages(model, monkeypatch):
    def plain(text):
        rows = np.concatenate([quality.describe([p])[0] for p in quality.parts_of(text)])
        z = np.zeros(quality.UNITS)
        if len(rows):
            h, e = model.encoded(rows)
            a = np.exp(e.astype(np.float64) - e.max())
            z = (a[:, None] / a.sum() * h).sum(axis=0)
        return float(quality.sigmoid(z @ model.weights["classify"].astype(np.float64) + model.weights["bias"][0]))

    long = " ".join(f"word{i % 97} Of,{i % 13}" for i in range(60_000))
    texts = [*TEXTS, long, TEXTS[4], "x" * 400_000]
    assert np.allclose(model.scores(texts), [plain(t) for t in texts], atol=1e-5)
    assert len(quality.parts_of(long)) > 3 and "".join(quality.parts_of(long)) == long
    monkeypatch.setattr(quality, "CHUNK", 300)
    assert np.allclose(model.scores(texts[:10]), [plain(t) for t in texts[:10]], atol=1e-5)


def test_attention_finds_the_passages_that_decide():
    rng = np.random.default_rng(2)
    good = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    texts, labels = [], []
    for k in range(300):
        junk = k % 3 == 0
        texts.append(good(200) + " " + ("###%% !!$$ " * 16 + "@@ %% " * 16 if junk else good(32)) + " " + good(200))
        labels.append(int(not junk))
    documents = [quality.describe([t])[0] for t in texts]
    fitted = quality.train(list(documents[:200]), np.array(labels[:200]))
    assert ((fitted.scores(texts[200:]) >= 0.5) == np.array(labels[200:])).mean() > 0.95


def test_op12_on_the_small_table_and_held_out_accuracy(spark, sf):
    rows = queries.op12_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    judged = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 90 and np.mean(judged) > 0.97


def test_labels_of_held_out_rows_are_not_learnt(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    taken = {r["_id"] for r in quality.training_rows(docs, labels).select("_id").collect()}
    assert taken and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in taken)


def test_awkward_rows(spark):
    schema = "doc_id string, text string, label int, _id long, score int, passages string, quality int, held_out string"
    texts = [*TEXTS, "Fine words stand here. " * 30, "%% $$ !! " * 90]
    docs = spark.createDataFrame([(f"d{i // 2}" if i else None, t, 1, 2, 3, "p", 4, "h") for i, t in enumerate(texts)], schema).repartition(3)
    labels = spark.createDataFrame([(f"d{i}", i % 2, 0) for i in range(6)] + [(None, 1, 0), ("d1", None, 0), ("d2", 7, 0), ("d2", 0, 1)], "doc_id string, quality int, _id int")
    got = quality.score_quality(docs, labels).collect()
    assert sorted(map(repr, (r["doc_id"] for r in got))) == sorted(repr(f"d{i // 2}" if i else None) for i in range(len(texts)))
    assert not [r for r in got if r["doc_id"] is None and r["held_out"]]
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert len({r["score"] for r in quality.score_quality(docs, none).collect()}) == 1
