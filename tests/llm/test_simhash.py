import random

import numpy as np
import pytest
import xxhash

from findery.llm import simhash as s
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def fingerprint(text):
    w = brute.words((text or "").translate(brute.ASCII_LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    """Smallest place that is reachable, by comparing all."""
    label = list(range(len(fps)))
    f = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= 2):
            a, b = i, int(j)
            while label[a] != a:
                a = label[a]
            while label[b] != b:
                b = label[b]
            label[max(a, b)] = min(a, b)
    for i in range(len(fps)):
        label[i] = label[label[i]]
    return label


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    label, least = classes(fps), {}
    for (d, _), k in zip(rows, label, strict=True):
        if d is not None:
            least[k] = min(least.get(k, d), d)
    return sorted(((d, f"{f:016x}", least.get(k)) for (d, _), f, k in zip(rows, fps, label, strict=True)), key=repr)


def found(df, **how):
    return sorted(((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in s.classes(df, **how).collect()), key=repr)


def some(n, seed=1):
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)


@pytest.mark.parametrize("name", ["coarse", "fine"])
def test_every_near_word_comes_to_the_home(name):
    code, rng, x = s.Code(name, 2), random.Random(1), some(400)
    homes = code.homes(x)
    assert (code.homes(homes) == homes).all()
    assert all(np.bitwise_count(x ^ homes) <= sum(p.radius for p in code.parts))
    y = x ^ np.array([sum(1 << b for b in rng.sample(range(64), rng.randrange(3))) for _ in x], np.uint64)
    who, at = code.anchors(y)
    came = set(zip(who.tolist(), at.tolist(), strict=True))
    assert len(came) == len(who)
    assert all((i, h) in came for i, h in enumerate(homes.tolist()))


def test_anchors_are_all_within_radius_and_threshold():
    """Of a small part, against all words."""
    for part in (s.hamming(0, 4, 2), s.hamming(0, 2, 2), s.free(0, 1, 2), s.golay(0, 2)):
        words = np.arange(1 << part.width, dtype=np.uint64) if part.width < 20 else some(20000) & np.uint64((1 << 23) - 1)
        syndromes = part.syndrome(words)
        anchors = words[syndromes == 0] if part.width < 20 else np.unique(words ^ part.patterns[part.first[syndromes]])
        assert len(anchors) and (part.syndrome(anchors) == 0).all()
        for w in words[:: max(1, len(words) // 50)]:
            k = int(part.syndrome(np.array([w]))[0])
            own = w ^ part.patterns[part.first[k] : part.first[k] + part.count[k, 2]]
            near = {int(a) for a in anchors if (int(a) ^ int(w)).bit_count() <= part.radius + 2}
            assert near <= set(own.tolist()) and len(set(own.tolist())) == len(own)
            if part.width < 20:
                assert near == set(own.tolist())


def test_fine_anchors_are_bounded():
    assert s.Code("fine", 2).most() < 50_000 and s.Code("coarse", 2).mean() == 165


@pytest.mark.parametrize("full", [1, 40, s.FULL])
def test_links_against_all_pairs(spark, full):
    rng = random.Random(2)
    base = [int(x) for x in some(60, 3)]
    fps = {x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for x in base for _ in range(12)}
    fps |= {0, 2**64 - 1, 1, 3, 7}
    signed = [(x - 2**64 if x >> 63 else x,) for x in sorted(fps)]
    df = spark.createDataFrame(signed, "fp long")
    links = s.links(df, full=full).collect()
    order = sorted(fps)
    label, at = classes(order), {x: i for i, x in enumerate(order)}
    own = list(range(len(order)))
    for r in links:
        a, b = (at[int.from_bytes(r[c], "big")] for c in ("a", "b"))
        while own[a] != a:
            a = own[a]
        while own[b] != b:
            b = own[b]
        own[max(a, b)] = min(a, b)
    for i in range(len(own)):
        own[i] = own[own[i]]
    assert own == label


def test_crowded_anchors_give_the_same_classes(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found(df, full=1) == found(df) == expected([(r["doc_id"], r["text"]) for r in df.collect()])


def test_hard_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c"), (7, "d e f"), (None, "a b c"), (None, "q r s"), (8, "A  B\nC"), (9, "w " * 200_000), (10, "w " * 200_001), (7, "a b c"), (11, "É é"), (12, "é é")]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, fp string, component_id int").repartition(3)
    assert found(df) == expected(rows)
    assert s.classes(df.limit(0)).count() == 0


def test_long_texts_are_voted_on_in_runs(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = s.fingerprint(text)
    monkeypatch.setattr(s, "_RUN", 7)
    assert s.fingerprint(text) == whole == fingerprint(text)


def test_query(spark):
    got = s.op12_simhash(spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
