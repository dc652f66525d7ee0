"""The audit of filter orders against applying the filters one by one in plain Python."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from reviewlab.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed_by(rows):
    """The letters each row (id, text, ...) fails."""
    least = {}
    for i, text in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    found = []
    for i, text in rows:
        text = text or ""
        words = WORD.findall(text)
        found.append("".join([
            "A" if len(words) < 100 else "", "B" if 100 * len(set(words)) < 80 * len(words) else "",
            "C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else "",
            "D" if set(text) & set("#$%&*|") else "", "E" if i is not None and least[text] < i else "",
        ]))
    return found


def audited(rows, labels):
    """All result rows, by really applying every order."""
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, bad in labels if bad == 1}
    fails = failed_by([(i, text) for i, text, _ in rows])
    result, removed_by = {}, Counter()
    for part in {lang or "" for _, _, lang in rows}:
        own = [(i, f) for (i, _, lang), f in zip(rows, fails) if (lang or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                failing = sum(letter in f for _, f in own)
                removed_by[part, letter] += len(gone)
                result[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(f == letter for _, f in own),
                    sum(i in good for i, _ in gone if i is not None), sum(i in toxic for i, _ in gone if i is not None),
                ]
    return {(*k, *v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in result.items()}


def check(spark, docs, labels):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()]
    expected = audited(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    found = filter_audit.audit_filters(docs, labels)
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_audit_equals_applying_every_order(spark, sf):
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (3, long, None), (None, long, "en"), (None, None, None),
        (4, None, "de"), (5, "", "de"), (6, "WORD " * 200, ""), (7, "a & b", "de"), (8, "x y " * 100, "fr"),
        (9, f"{long} | WORDS AND MORE", "en"), (10, "wort " * 50_000, "de"), (5, "", "en"), (11, f"{long}\tw0", "en"),
    ]
    schema = "doc_id long, text string, lang string, mask string, n int, part string, id string, spread string"
    docs = spark.createDataFrame([(*r, "x", 1, "y", "z", "s") for r in rows], schema)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (None, 1, 1), (6, 1, None)], "doc_id long, quality int, toxic int"
    )
    check(spark, docs, labels)
    check(spark, docs, labels.limit(0))
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0


def test_many_copies_and_repeated_rows(spark):
    """A third of all rows are one row, a third copies of one text, and no count is lost."""
    n = 60_000
    docs = spark.range(3 * n).selectExpr(
        f"CASE WHEN id < {n} THEN 0 ELSE id END AS doc_id",
        f"CASE WHEN id < {2 * n} THEN 'one text' ELSE concat('text ', id) END AS text", "'en' AS lang",
    )
    labels = spark.range(3 * n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    rows = filter_audit.audit_filters(docs, labels).where("filter_order = 'EABCD'").collect()
    first = next(r for r in rows if r.step == 1)
    assert (first.removed, first.kept, first.good_lost) == (n, 2 * n, n)


def test_min_plus_equals_the_first_failing_step():
    tables = filter_audit.OrderTables("ABCD")
    for mask in range(16):
        for number, name in enumerate(tables.names):
            steps = [step for step, letter in enumerate(name) if mask >> "ABCD".index(letter) & 1]
            assert tables.steps[mask, number] == (steps[0] if steps else 4)
    assert tables.audit(np.zeros((16, 3), np.int64))["kept"].sum() == 0


def test_letters_are_checked(spark):
    masks = spark.createDataFrame([], "part string, mask int, n long, good long, toxic long")
    for letters in ("", "AA", "ABCDEFGH"):
        with pytest.raises(ValueError):
            filter_audit.interaction_audit(masks, letters)
