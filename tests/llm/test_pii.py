"""Base spans against plain regular expressions, and discovery by context."""

import hashlib
import random
import re

from reviewlab.llm import pii, queries

SCHEMA = "doc_id long, text string, base string, _row int"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_spans(text):
    """The forms as they are defined, without any care for speed."""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def random_texts(n):
    rng = random.Random(7)
    bits = ["@", ".", "-", "+", "(", ")", " ", "a", "Z", "_", "%", "1", "23", "255", "256", "0", "4111111111111111",
            "4111 1111 1111-1111", "+49 30 123456", "a@b.c", "x.y@z-1.org", "1.2.3.4", "\n", "é", "😀", "٣", "--", "  "]
    return ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(n)]


def test_base_spans():
    for text in ["", "@", "a@b", "a@b.c@d.e", "a@b.c.@d.e", "1.2.3.4.5.6.7.8.9", "000255.1.1.1", *random_texts(20_000)]:
        assert sorted((s, k, e) for k, s, e in pii.base_spans(text)) == plain_spans(text), repr(text)


def test_loose_spans_leave_base_spans_alone():
    for text in random_texts(5000):
        base = pii.base_spans(text)
        for _, start, end in pii.loose_spans(text, base):
            assert all(e <= start or s >= end for _, s, e in base)


def test_query_base_columns(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op1_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert set(listed(spans).split(",")) <= set(r.spans.split(","))


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(1)
    words = [f"w{i}x" for i in range(300)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    rows = [
        (i, f"{prose(30)} card number 4{rng.randint(10**13, 10**14)} expires soon {prose(20)}", None, None)
        for i in range(200)
    ]
    for i, (doc, text, *_rest) in enumerate(rows):  # give each number its check digit
        number = re.search(r"\b4[0-9]{14}\b", text).group()
        digit = next(d for d in "0123456789" if luhn(number + d))
        rows[i] = (doc, text.replace(number, number + digit), None, None)
    bad = "4111111111111112"
    rows += [(1000, f"{prose(9)} card number {bad} expires soon", None, None), (1001, f"the order {bad[::-1]} of {prose(5)}", None, None)]
    found = {r.doc_id: r.found for r in pii.find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    text = rows[200][1]
    assert [(s.kind, text[s.start:s.end]) for s in found[1000]] == [(2, bad)]
    assert not found[1001] and not any(found[i] for i in range(200))


def test_discovered_identifiers_induce_contexts(spark):
    """A field without any base form: its loose forms are known from another field, but for one."""
    rng = random.Random(2)
    words = [f"w{i}x" for i in range(300)]

    def row(i, before, value, after):
        around = [" ".join(rng.choices(words, k=12)) for _ in range(2)]
        return (i, f"{around[0]} {before} {value} {after} {around[1]}", None, None)

    rows = [row(i, "mail me", f"base{i}@host.org", "for details") for i in range(30)]
    rows += [row(100 + i, "mail me", f"loose{i}[at]host.org", "for details") for i in range(10)]
    rows += [row(200 + i, "contact field", f"loose{i}[at]host.org", "end field") for i in range(10)]
    rows += [row(300, "contact field", "unseen[at]host.org", "end field")]
    found = {r.doc_id: len(r.found) for r in pii.find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: int(i >= 100) for i, *_ in rows}


def test_odd_rows(spark):
    rows = [(1, None, "x", 1), (2, "", None, None), (3, "a@b.cd", "x", 1), (3, "a@b.cd", "x", 1), (None, "a@b.cd", "x", 1),
            (3, "other text 10.0.0.1", "x", 1), (4, "9" * 300_000 + "@" * 1000, "x", 1), (5, "a" * 300_000 + " 1.1.1.1", "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sorted((r.doc_id or 0, [(s.kind, s.start, s.end) for s in r.base]) for r in pii.find_pii(docs).collect())
    assert found == [(0, [(0, 0, 6)]), (1, []), (2, []), (3, [(0, 0, 6)]), (3, [(0, 0, 6)]), (3, [(1, 11, 19)]), (4, []), (5, [(1, 300_001, 300_008)])]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_loose_forms_of_any_length():
    domain = "".join(f".label{i}" for i in range(40))
    for form in (f"{'n' * 500} [at] host{domain}", f"name(at){'h' * 300} (dot) org", f"a@{'b' * 200}"):
        text = f"write to {form}, please"
        assert [text[s:e] for _, s, e in pii.loose_spans(text, [])] == [form]
    spaced = "0170" + " " * 60 + "1234567"
    assert [spaced[s:e] for _, s, e in pii.loose_spans(spaced, [])] == [spaced]
    assert pii.loose_spans("1 " * 200_000 + "x", []) == [] == pii.loose_spans("12345678x", [])


def test_loose_forms_beside_many_base_forms():
    base = [(0, i, i + 1) for i in range(20)]
    text = "." * 20 + " 0170 1234567 "
    assert pii.loose_spans(text, base) == [(3, 21, 33)]
    assert pii.loose_spans(text, [*base, (2, 0, 25)]) == []


def test_contexts_of_long_words():
    left, right = f"{'a' * 900} {'b' * 3000}", f"{'c' * 2000} {'d' * 5000}"
    for text in (f"x {left} 0170 {right} y", f"{left} 0170 {right}"):
        at = text.index("0170")
        assert pii._context(text, at, at + 4) == (left, right)
    assert pii._context("a 0170 b", 2, 6) == (None, None)


def bootstrap(occurrences, texts):
    """Accepted loose forms by the same rules, over plain dictionaries, until nothing changes."""
    edges, base = {}, {}
    for kind, surface, known, left, right in occurrences:
        instance = (kind, surface)
        base[instance] = base.get(instance, False) or known
        for side, words in (("L", left), ("R", right)):
            if words is not None:
                own = edges.setdefault((kind, side, words), {})
                n, was = own.get(instance, (0, False))
                own[instance] = (n + 1, was or known)
    pairs = {}
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(pii._TO_LOWER))
        for pair in zip(words, words[1:]):
            pairs[" ".join(pair)] = pairs.get(" ".join(pair), 0) + 1
    held = {i for own in edges.values() for i in own}
    score = {i: float(b) for i, b in base.items() if i in held}
    admitted = set()
    while True:
        new = {
            p for p, own in edges.items() if p not in admitted and not all(b for _, b in own.values())
            and sum(b or (bool(admitted) and score[i] >= pii.ACCEPTED) for i, (_, b) in own.items()) >= pii.LEAST_SEEDS
        }
        if not new:
            break
        admitted |= new
        moved = 1.0
        while moved > pii.SETTLED:
            trust = {p: min(0.99, sum(n * score[i] for i, (n, _) in edges[p].items()) / pairs[p[2]]) for p in admitted}
            after = dict(score)
            for i in score:
                own = [p for p in admitted if i in edges[p]]
                if own:
                    doubt = 1.0
                    for p in own:
                        doubt *= 1 - trust[p]
                    after[i] = 1.0 if any(edges[p][i][1] for p in own) else 1 - doubt
            moved = max(after[i] - score[i] for i in score)
            score = after
    return {i for i, s in score.items() if s >= pii.ACCEPTED}


def test_discovery_equals_plain_bootstrap(spark):
    """Planted contexts of growing purity, some words of which also stand elsewhere."""
    rng = random.Random(3)
    words = [f"w{i}x" for i in range(40)]
    contexts = [(f"ctx{c} lead{c}", f"tail{c} end{c}") for c in range(12)]
    texts = []
    for i in range(400):
        c = rng.randrange(12)
        form = rng.choice([f"a{i % 60}@h{c}.org", f"l{i % 45}[at]h{c}.org", f"l{i % 45}[at]h.org", "nothing"])
        before, after = contexts[c]
        noise = " ".join(rng.choices([*words, *contexts[c]], k=12))
        texts.append(f"{noise} {before} {form} {after if rng.random() < 0.7 else ' '.join(rng.choices(words, k=2))} {noise}")
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    occurrences = []
    for text in texts:
        base = pii.base_spans(text)
        for (kind, s, e), known in [(b, True) for b in base] + [(f, False) for f in pii.loose_spans(text, base)]:
            occurrences.append((kind, pii._normal(kind, text[s:e]), known, *pii._context(text, s, e)))
    accepted = bootstrap(occurrences, texts)
    loose = {(k, f) for k, f, known, *_ in occurrences if not known}
    found = set()
    for r in pii.find_pii(spark.createDataFrame(rows, SCHEMA)).collect():
        found |= {(s.kind, pii._normal(s.kind, texts[r.doc_id][s.start:s.end])) for s in r.found}
    assert found == accepted & loose and 0 < len(found) < len(loose)
