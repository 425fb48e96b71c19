import random
import re

import numpy as np
import pytest
import xxhash

from lakekit.llm import hamming, queries, simhash
from lakekit.llm.components import components
from lakekit.llm.simhash import near_duplicates, without_near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text):
    words = WORD.findall(lowered(text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, most=3):
    """Smallest index of the component of each value, by all pairs."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    array = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1:]) <= most):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_query_against_all_pairs(spark, folder):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    prints = [fingerprint(t) for _, t in rows]
    expected = {d: (f"{f:016x}", rows[g][0]) for (d, _), f, g in zip(rows, prints, groups(prints), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_simhash_near_duplicates(spark, folder).collect()} == expected


def made_prints(seed, centres=40, near=30):
    """Random fingerprints, chains of near ones, and one dense ball."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(centres)]
    for base in list(out):
        for _ in range(rng.randint(0, 4)):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            out.append(base)
    ball = rng.getrandbits(64)
    out += [ball ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(near)]
    return sorted(set(out))


@pytest.mark.parametrize(("limits", "parts"), [(None, None), ([1, 1], 2), ([1, 0, 0], 3), ([0, 0, 0, 0], 4), ([2, 0], 2), ([0, -1, 1, 0], 4)])
@pytest.mark.parametrize("hot", [hamming.HOT, 30])
def test_links_connect_as_all_pairs_do(spark, limits, parts, hot):
    values = made_prints(3, near=60)
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    if limits is None:
        links = simhash.fingerprint_links(rows)
    else:
        split = [list(range(64))[k::parts] for k in range(parts)]
        dealt = rows.mapInArrow(simhash._bucket_rows(split, limits), "key long, fp long, role int, fixed long")
        links = hamming.near_links(dealt, 3, "test", hot=hot)
    found = {r.node: r.component for r in components(links).collect()}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    expected = {}
    for v, g in zip(signed, groups(values), strict=True):
        expected.setdefault(g, []).append(v)
    labelled = {}
    for v in signed:
        labelled.setdefault(found.get(v, v), []).append(v)
    assert sorted(map(sorted, labelled.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_find_every_pair():
    rng = np.random.default_rng(1)
    differ = rng.uniform(0.05, 0.5, 64)
    for parts in range(2, 7):
        split = [list(range(64))[k::parts] for k in range(parts)]
        for n in (100, 10_000, 10 ** 9):
            cost, limits = simhash.thresholds(split, differ, n, 3)
            assert sum(t + 1 for t in limits) == 4 and cost > 0


def test_correlated_bits_are_grouped():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (2000, 64))
    bits[:, 40:48] = bits[:, [3]]
    together = bits.T @ bits
    assert any({3, *range(40, 48)} <= set(g) for g in simhash.grouped_bits(together, 2000, 4))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + star + [(5000, 5000), (None, 3), (7001, 7000), (7000, 7001)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 1 for i in range(1, 201)} | {1000 + i: 1000 for i in range(300)} | {7000: 7000, 7001: 7000}
    assert components(links.where("false")).count() == 0


def test_awkward_rows(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    found = near_duplicates(awkward).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by_id[2] == by_id[3] == by_id[4] == {("0" * 16, 2)}  # null, empty and blank texts have fingerprint zero
    assert by_id[None] == {(f"{fingerprint('Un texte sans numéro, avec des mots français dedans.'):016x}", None)}
    kept = without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 5, 6, 7]
    assert near_duplicates(nothing).count() == 0 and without_near_duplicates(nothing).count() == 0


def test_majority_of_groups_of_any_size():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 2, 254, 255, 256, 0, 511, 3000, 0]
    first = np.append(0, np.cumsum(sizes))
    hashes = rng.integers(0, 1 << 64, first[-1], dtype=np.uint64) & np.uint64(0xFFFF0000FFFFFFFF)
    expected = [sum((2 * sum(h >> bit & 1 for h in group) > len(group)) << bit for bit in range(64))
                for group in (hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True))]
    assert simhash.majority(hashes, first).tolist() == expected
    assert simhash.majority(np.zeros(0, np.uint64), np.array([0, 0])).tolist() == [0]
