"""Fingerprints, links and components against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewlab.llm import components, queries, simhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius=4):
    """Smallest index reachable over links, by comparing all pairs."""
    values = np.array(values, np.uint64)
    label = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    while True:
        new = np.array([label[n].min() for n in near])
        if np.array_equal(new, label):
            return label
        label = new


def by_id(rows):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    prints = [fingerprint(d["text"]) for d in docs]
    expected = {
        d["doc_id"]: (f"{fp:016x}", docs[root]["doc_id"])
        for d, fp, root in zip(docs, prints, roots(prints))
    }
    assert by_id(queries.op6_simhash_near_dedup(spark, sf).collect()) == expected


@pytest.mark.parametrize("block", [16, 4096])
def test_links_keep_all_components(spark, block):
    """Dense groups and chains, with buckets far above the block size."""
    rng = np.random.default_rng(5)
    values = [int(v) for v in rng.integers(0, 2**64, 400, dtype=np.uint64)]
    centre = values[0]
    values += [centre ^ (1 << int(b)) ^ (1 << int(c)) for b in range(24) for c in range(24)]
    for step in range(30):  # a chain, four bits at a time
        values.append(values[-1] ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
    values = sorted(set(values))
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    links = simhash.similar_fingerprints(spark.createDataFrame(signed, "fp long"), block=block)
    found = {r.node: r.root for r in components.connected_components(links).collect()}
    label = roots(values)
    groups = {}
    for (s,), root in zip(signed, label):
        groups.setdefault(root, set()).add(found.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 8, 11, 16])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    task = np.sort(rng.integers(0, 6, 500))
    fp = rng.integers(0, 2**(12 if radius < 8 else 40), 500).astype(np.uint64)
    found = {(i, j) for a, b in simhash.bit_sliced_links(task, fp, radius) for i, j in zip(a.tolist(), b.tolist())}
    expected = {
        (i, j) for i in range(500) for j in range(i + 1, 500)
        if task[i] == task[j] and bin(int(fp[i] ^ fp[j])).count("1") <= radius
    }
    assert found == expected


def test_edges_of_a_chain(spark):
    links = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in components.connected_components(links).collect()}.__len__() == 1


def test_odd_rows(spark):
    schema = "doc_id long, text string, fp string, component_id int"
    rows = [(5, None, "x", 1), (3, "", "x", 1), (4, " \n", None, None), (7, "one two", "x", 1),
            (8, "ONE  two", "x", 1), (8, "ONE  two", "x", 1), (None, "one two", "x", 1), (9, "w " * 50_000, "x", 1)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert {by[i].component_id for i in (3, 4, 5)} == {3} and by[5].fp == 0
    assert {by[i].component_id for i in (7, 8, None)} == {7}
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("radius", [4, 8, 9])
def test_wide_radius_keeps_all_links(spark, radius):
    rng = np.random.default_rng(radius)
    values = [int(v) for v in rng.integers(0, 2**64, 40, dtype=np.uint64)]
    values += [v ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for v, n in zip(values, [radius, radius + 1] * 20)]
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    links = simhash.similar_fingerprints(spark.createDataFrame(signed, "fp long"), radius)
    found = {r.node: r.root for r in components.connected_components(links).collect()}
    label = roots(values, radius)
    joined = {tuple(sorted(s for (s,), root in zip(signed, label) if root == r)) for r in set(label)}
    parts = {}
    for (s,) in signed:
        parts.setdefault(found.get(s, s), []).append(s)
    assert {tuple(sorted(p)) for p in parts.values()} == joined and len(joined) < len(values)


def test_radius_is_checked(spark):
    fps = spark.createDataFrame([(1,)], "fp long")
    for radius in (-1, 17):
        with pytest.raises(ValueError):
            simhash.similar_fingerprints(fps, radius)
