"""Repaired conversations against a plain search over the grammar's places."""

import functools
import hashlib
import zlib

import numpy as np
import pytest

from annospark.llm import queries, turn_repair

SPACE = " \t\n\v\f\r"


def repair(turns):
    """(cost, audit, repaired) of (initial, gone, truncated, role, text) turns, by trying all edits with up to 3 insertions in a row."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, place, more):
        out = [(0, "", ())] if i == len(turns) and place in ("", "a") else []
        if i < len(turns):
            initial, gone, truncated, role, text = turns[i]
            options = [(2, "D", place, ())]
            if not gone:
                for to in steps[place]:
                    if initial == to:
                        options.append((5 * truncated, "K", to, (f"{role}:{text}",)))
                    elif to != "s":
                        options.append((1 + 5 * truncated, "R", to, ({"u": "user", "a": "assistant"}[to] + f":{text}",)))
            for cost, letter, to, line in options:
                if (rest := best(i + 1, to, 3)) is not None:
                    out.append((cost + rest[0], letter + rest[1], line + rest[2]))
        if more:
            for to in steps[place]:
                if to != "s" and (rest := best(i, to, more - 1)) is not None:
                    out.append((5 + rest[0], "I" + rest[1], ({"u": "user", "a": "assistant"}[to] + ":",) + rest[2]))
        return min(out, key=lambda x: x[:2], default=None)

    return best(0, "", 3)


def brute(rows):
    """Result rows for (conv_id, turn, role, text)."""
    space = lambda v: " " if v is None else v
    out = []
    for conv in {r[0] for r in rows}:
        damaged = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
            role, text = space(role), space(text)
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
            damaged += [(turn, "user" if kind == 4 else role, text)] * (kind != 0) * (2 if kind == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, counts = [], set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in damaged:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            turns.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated", role, text))
        known = [t for t, _, _ in damaged if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, lines = repair(tuple(turns))
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=repr)


def test_op11_on_the_small_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_turn_repair(spark, sf)) == brute(rows)


SCHEMA = "conv_id long, turn long, role string, text string, at long, length int, digest string, place int, audit int, piece int"


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(5)
    texts, roles = ["Hello.", "Yes!", "And then", "", " \n", None, "What? ", "No ", "a.b"], ["user", "assistant", "system", "tool", "User", "", None, "u", " "]
    weights = [0.35, 0.3, 0.1, 0.05, 0.05, 0.05, 0.04, 0.03, 0.03]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(int(rng.integers(1, 14))):
            own = f"{rng.integers(1000)} {t}" if rng.random() < 0.6 and (t := texts[rng.integers(9)]) else texts[rng.integers(9)]
            rows.append((conv, None if rng.random() < 0.1 else int(turn + rng.integers(0, 2)), roles[rng.choice(9, p=weights)], own))
    rows += [rows[5]] * 3 + [(300, 2**40, "user", "long " * 200_000 + "."), (300, 2**40 + 1, "assistant", "x" * 500_000)]
    rows += [(301, turn, ("user", "assistant")[turn % 2], f"Turn {turn}.") for turn in range(700)]
    return rows


def test_nulls_ties_repeats_long_texts_and_clashing_names(spark, awkward):
    df = spark.createDataFrame([(*r, 1, 2, "d", 3, 4, 5) for r in awkward], SCHEMA)
    want = brute(awkward[:-702]) + brute(awkward[-702:-700])
    assert got(turn_repair.repair(df.where("conv_id is null or conv_id < 301").repartition(5))) == sorted(want, key=repr)
    assert got(turn_repair.repair(df.limit(0))) == []


def test_a_conversation_in_many_segments_is_repaired_as_a_whole(spark, awkward, monkeypatch):
    # Runs of 8 turns and segments of 16 put the same conversations together from many parts.
    df = spark.createDataFrame([(*r, 1, 2, "d", 3, 4, 5) for r in awkward], SCHEMA).where("conv_id < 20 or conv_id >= 300").repartition(7)
    want = got(turn_repair.repair(df))
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", 4)
    monkeypatch.setattr(turn_repair, "PIECE_LINES", 4)
    assert got(turn_repair.repair(df)) == want


def test_alignment_of_random_runs_and_of_their_parts(monkeypatch):
    rng = np.random.default_rng(6)
    letters = "".join(turn_repair.LETTERS.values())
    role = {c: "suao"[i % 4] for i, c in enumerate(letters)}
    runs = ["".join(rng.choice(list(letters), int(n))) for n in rng.integers(1, 12, 300)]
    runs += ["".join(rng.choice(list("ua"), int(n))) for n in rng.integers(1, 30, 100)]

    def want(run):
        cost, audit, _ = repair(tuple((role[c], c in "1234", c in "SUAO", role[c], str(k)) for k, c in enumerate(run)))
        return cost, audit.encode()

    for size in (64, 5, 1):
        monkeypatch.setattr(turn_repair, "RUN", size)
        for run, paths in zip(runs, turn_repair.segments_aligned(runs), strict=True):
            assert turn_repair.cheapest([paths]) == want(run), run
    parts = [[run[i : i + 4] for i in range(0, len(run), 4)] for run in runs]
    for run, own in zip(runs, parts, strict=True):
        assert turn_repair.cheapest(turn_repair.segments_aligned(own)) == want(run), run
