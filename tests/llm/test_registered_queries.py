"""The registered functions on the small tables against plain Python, and the stages on awkward rows."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import pytest
from test_operators import SCHEMA, TEXTS, ascii_lower, brute_fingerprint, brute_secrets, library, roots

import corpus_pipeline
from annospark.llm import media, packing, queries


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(spark, sf, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, sf).collect()}


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_op1(spark, sf, docs):
    t, got = library("byte_bpe_50k.json"), rows_of(spark, sf, "op1_token_counts")
    assert got.keys() == docs.keys()
    for i, x in docs.items():
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((x or "").encode()), n, n > 512)


def test_op3(spark, sf, docs):
    t, got = library("word_bpe_49k.json"), rows_of(spark, sf, "op3_bpe_round_trip")
    assert got.keys() == docs.keys()
    for i, x in docs.items():
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert got[i]["decoded_sha256"] == sha(t.decode(ids, skip_special_tokens=False).encode())


def test_op4(spark, sf, docs):
    got, names = rows_of(spark, sf, "op4_simhash"), sorted(docs)
    fp = [brute_fingerprint(docs[i], 4) for i in names]
    root = roots(len(fp), [(a, b) for a, b in itertools.combinations(range(len(fp)), 2) if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert {i: (got[i]["fingerprint"], got[i]["component_id"]) for i in got} == {i: (f"{f:016x}", names[r]) for i, f, r in zip(names, fp, root, strict=True)}


def test_op5(spark, sf, docs):
    got = rows_of(spark, sf, "op5_telephony")
    assert got.keys() == docs.keys()
    for i, x in docs.items():
        raw = (x or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        file = media.store(payload, media.coding_of(payload))
        assert (got[i]["n_bytes"], got[i]["payload_bytes"], got[i]["payload_sha256"], got[i]["tail_crc32"]) == (len(raw), len(payload), sha(payload), zlib.crc32(payload[-32:]))
        assert (got[i]["media_bytes"], got[i]["media_sha256"]) == (len(file), sha(file))


def test_op6(spark, sf, docs):
    t, got = library("byte_bpe_50k.json"), rows_of(spark, sf, "op6_packing")
    n = {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in docs.items()}
    assert {i: r["n_tokens"] for i, r in got.items()} == n
    # The least padding of all, by trying every last boundary for every number of buckets.
    top = sorted(set(n.values()))
    count = collections.Counter(n.values())
    cost = lambda a, b: sum(count[t] * (top[b - 1] - t) for t in top[a:b])
    best = [0] + [10**18] * len(top)
    for _ in range(packing.BUCKETS):
        best = [0] + [min(best[b], min(best[a] + cost(a, b) for a in range(b))) for b in range(1, len(top) + 1)]
    assert sum(r["padded"] - r["n_tokens"] for r in got.values()) == best[-1]
    batches = collections.defaultdict(list)
    for r in got.values():
        batches[r["bucket"], r["batch"]].append(r)
    assert all(len(b) == 1 or len(b) * b[0]["padded"] <= packing.BUDGET for b in batches.values())
    assert all(sorted(r["slot"] for r in b) == list(range(len(b))) and len({r["padded"] for r in b}) == 1 for b in batches.values())


def test_op8(spark, sf, docs):
    t, got = library("byte_bpe_50k.json"), rows_of(spark, sf, "op8_lm_score")
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in docs.items()}
    assert all(r["log_prob"] < 0 and abs(r["mean_log_prob"] * r["n_tokens"] - r["log_prob"]) < 1e-6 * -r["log_prob"] for r in got.values() if r["n_tokens"])
    again = rows_of(spark, sf, "op8_lm_score")
    assert all(abs(again[i]["log_prob"] - got[i]["log_prob"]) <= 1e-4 * max(1, got[i]["n_tokens"]) for i in got)


def test_op9(spark, sf, docs):
    got = rows_of(spark, sf, "op9_toxicity")
    assert got.keys() == docs.keys()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op10(spark, sf, docs):
    got = rows_of(spark, sf, "op10_secret_scan")
    assert got.keys() == docs.keys()
    for i, x in docs.items():
        base = brute_secrets(x or "")
        said = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(b[0] == k for b in base) for k in ("assign", "access", "hex")]
        assert got[i]["base_sha256"] == sha(",".join(said).encode()) and [s for s in got[i]["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")] == said


@pytest.fixture(scope="module")
def awkward(spark):
    """Repeated, null, blank and long rows, with columns named as the stages' own."""
    rows = [(i, t, None, "s", None, 9, "n", 1, "f", 2, "k", 3, "y") for i, t in TEXTS]
    rows += [(30, "long " * 60_000 + "end", "en", "s", 300_003, 9, "n", 1, "f", 2, "k", 3, "y")] * 2
    return spark.createDataFrame(rows, SCHEMA.replace("row long", "key_id long").replace("name string", "x string").replace("fp string", "_row string")).repartition(3)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_on_awkward_rows_and_on_none(spark, sf, awkward, name, stage):
    got = stage(spark, awkward, sf)
    before, after = collections.Counter(map(tuple, awkward.collect())), collections.Counter(map(tuple, got.collect()))
    if name == "packing":
        assert sum(after.values()) == len(TEXTS) + 2
    else:
        assert got.columns == awkward.columns and dict(got.dtypes) == dict(awkward.dtypes)
    if name == "exact dedup":
        texts = collections.Counter(ascii_lower(r[1]) for r in after.elements())
        assert set(texts.values()) == {1} and texts.keys() == {ascii_lower(r[1]) for r in before} and after <= before
    elif name in ("toxicity", "SimHash near-dedup"):
        assert after <= before and len(after) >= 10
    elif name == "secret scans":
        assert sum(after.values()) == sum(before.values())
    assert stage(spark, awkward.limit(0), sf).count() == 0
