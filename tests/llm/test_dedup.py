from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from mailtax.llm import simhash, suffixes
from mailtax.llm.components import connected_components, forest


def plain_fingerprint(text, n):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    label = list(range(len(nodes)))
    for i, j in combinations(range(len(nodes)), 2):
        if near(nodes[i], nodes[j]):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_golay_code():
    words = simhash.golay_codewords()
    weights = Counter(np.bitwise_count(words).tolist())
    assert weights == {0: 1, 7: 253, 8: 506, 11: 1288, 12: 1288, 15: 506, 16: 253, 23: 1}


def test_words_two_bits_apart_share_an_index():
    """By linearity it is enough to look at one word of each coset, with every error of two bits or less."""
    table = simhash.golay_table()
    leaders = np.array([sum(1 << i for i in c) for k in range(4) for c in combinations(range(23), k)], np.int64)
    row, index = simhash.golay_indices(leaders, table)
    mine = [set() for _ in leaders]
    for r, i in zip(row.tolist(), index.tolist()):
        mine[r].add(i)
    assert {len(m) for m in mine} == {1, 6}
    for k in (1, 2):
        for c in combinations(range(23), k):
            row, index = simhash.golay_indices(leaders ^ sum(1 << i for i in c), table)
            shared = np.zeros(len(leaders), bool)
            for r, i in zip(row.tolist(), index.tolist()):
                shared[r] |= i in mine[r]
            assert shared.all()


def test_fingerprints_four_bits_apart_share_a_key(rng):
    table = simhash.golay_table()
    a = np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64)
    b = np.array([int(x) ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for x in a], np.uint64)
    keys = [set() for _ in a], [set() for _ in a]
    for side, values in zip(keys, (a, b)):
        for r, k in zip(*simhash.fuzzy_keys(values, table)):
            side[r].add(int(k))
    assert all(x & y for x, y in zip(*keys))


def test_forest(rng):
    for _ in range(50):
        edges = [(rng.randint(-20, 20), rng.randint(-20, 20)) for _ in range(rng.randint(0, 30))]
        node, root = forest(np.array([u for u, _ in edges], np.int64), np.array([v for _, v in edges], np.int64))
        nodes = sorted({x for e in edges for x in e})
        linked = {frozenset(e) for e in edges}
        label = plain_components(nodes, lambda x, y: frozenset((x, y)) in linked)
        assert dict(zip(node.tolist(), root.tolist())) == {n: nodes[k] for n, k in zip(nodes, label) if nodes[k] != n}


def test_connected_components(spark, rng):
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({x for u, v in edges if u != v for x in (u, v)})
    linked = {frozenset(e) for e in edges}
    label = plain_components(nodes, lambda x, y: frozenset((x, y)) in linked)
    assert found == {n: nodes[k] for n, k in zip(nodes, label)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).isEmpty()


@pytest.mark.parametrize("block", [2000, 3])
def test_near_links_find_all_components(spark, rng, block):
    """Chains and dense groups; small blocks split every key."""
    values = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(15):
            x ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4)))
            values.add(x)
    base = rng.getrandbits(64)
    values |= {base ^ sum(1 << i for i in rng.sample(range(64), 2)) for _ in range(60)}
    values = sorted(values)
    rows = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    found = {r.node: r.root for r in connected_components(simhash.near_links(rows, block=block)).collect()}
    label = plain_components(values, lambda x, y: (x ^ y).bit_count() <= 4)
    groups = {}
    for v, k in zip(values, label):
        groups.setdefault(k, set()).add(found.get(int(np.uint64(v).astype(np.int64)), v))
    assert all(len(roots) == 1 for roots in groups.values())
    assert len({next(iter(r)) for r in groups.values()}) == len(groups)


def test_near_duplicates_against_brute_force(documents):
    found = {r.doc_id: r for r in simhash.near_duplicates(documents, words=4).collect()}
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    prints = [plain_fingerprint(t, 4) for _, t in rows]
    label = plain_components(prints, lambda x, y: (x ^ y).bit_count() <= 4)
    for (doc, _), fp, k in zip(rows, prints, label):
        assert found[doc].fingerprint == f"{fp:016x}" and found[doc].component_id == rows[k][0]


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 9
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(zero) == 4 and {r.component_id for r in zero} == {1}
    assert [r.component_id for r in rows if r.doc_id == 4] == [4, 4]
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]  # one word decides a majority of two shingles
    assert simhash.near_duplicates(empty).isEmpty() and simhash.keep_first(empty).isEmpty()


def plain_removal(texts, n):
    starts = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if starts[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("length,block", [(32, 512), (32, 4), (400, 512)])
def test_repeats_against_brute_force(spark, documents, rng, length, block):
    """Copies, edits, passages inside of others, self-repeats, nulls; small blocks refine buckets in Spark."""
    if length == 400:
        texts = [r.text for r in documents.orderBy("doc_id").collect()]
    else:
        letters = "ab cdé"
        make = lambda n: "".join(rng.choice(letters) for _ in range(n))
        base, common = make(300), make(60)
        texts = [None, "", "short", base, base, base[:150] + "X" + base[150:], "a" * 100, "ab" * 60, "aaa" * 20 + base[20:90]]
        texts += [make(rng.randint(0, 60)) + common + make(rng.randint(0, 60)) for _ in range(30)]
        texts += [make(rng.randint(0, 150)) for _ in range(30)]
        for _ in range(15):
            edited = list(base)
            edited[rng.randrange(300)] = "z"
            texts.append("".join(edited))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffixes.remove_repeats(rows, length, block=block).orderBy("doc_id").collect()
    expected = plain_removal([(t or "").encode() for t in texts], length)
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == expected


def test_anchors_do_not_depend_on_chunks(rng, monkeypatch):
    data = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(3000)) + b"a" * 500, np.uint8)
    whole = suffixes.anchors(data, 50, suffixes.Rolling(suffixes.CHUNK + 50))
    monkeypatch.setattr(suffixes, "CHUNK", 512)
    for a, b in zip(whole, suffixes.anchors(data, 50, suffixes.Rolling(512 + 50))):
        assert a.tolist() == b.tolist()


def test_repeats_of_odd_rows(odd, empty):
    rows = suffixes.remove_repeats(odd, 400).collect()
    assert len(rows) == 9
    assert sorted(r.n_removed for r in rows)[-2:] == [220_000, 220_000]
    assert {r.n_spans for r in rows if r.n_bytes < 400} == {0}
    assert suffixes.remove_repeats(empty, 400).isEmpty()
