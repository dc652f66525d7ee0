"""Personal data: exact base forms, and more identifiers found by bootstrapped contexts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import (
    LOWER, UPPER, ascii_lower, join_by_row, schema_with, split_words, text_first, with_row_hash,
)
from reviewlab.operators.lookup import lookup_join
from reviewlab.session import materialize

KINDS = ["email", "ip", "card", "phone"]
#: A context counts from three different seeds on; an identifier from this probability on; scores are settled
#: when none grows by more than the last number.
LEAST_SEEDS, ACCEPTED, SETTLED = 3, 0.8, 1e-3
#: A table of so many 64-bit hashes takes about 50 MB; beyond it the join is salted instead.
BROADCAST_HASHES = 2_000_000

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# every run is taken whole and never given back, so a form of any length costs one pass
_LOOSE_EMAIL = re.compile(r"(?<![^\s<(\"'])[\w.%+-]++(?:@| ?[\[(]at[\])] ?)[\w-]++(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]++)*+")
_LOOSE_NUMBER = re.compile(r"(?<![\w.+-])[0-9(](?:[ ().-]*+[0-9])++")
_GOES_ON = re.compile(r"[\w-]")
_BLANK = re.compile(r"[ \t-\r]+")
_TO_LOWER = str.maketrans(UPPER, LOWER)
_SEEN = 400  # characters on each side in which context words are looked for first; more where words are longer
_FOUND = "kind:int, start:int, end:int"
_CONTEXT = f"struct<{_FOUND}, surface:string, base:boolean, left:string, right:string>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """`(kind, start, end)` of the base forms, leftmost and non-overlapping per kind."""
    spans = [(0, *s) for s in _emails(text)]
    if _DIGIT.search(text) is None:
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = [int(c) for c in m.group() if c not in " -"] if m.end() - m.start() <= 40 else []
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            spans.append((3, *m.span()))
    return spans


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every `@` outwards, so that long runs without one cost nothing."""
    at, bound = text.find("@"), 0
    while at >= 0:
        start = at
        while start > bound and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            bound = domain.end()
            yield start, bound
        at = text.find("@", max(bound, at + 1))


def _luhn(digits: list[int]) -> bool:
    doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Forms that may be identifiers but fail the base rules, apart from all base spans."""
    found = []
    if "@" in text or "at]" in text or "at)" in text:
        found += [(0, *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text) is not None:
        for m in _LOOSE_NUMBER.finditer(text):
            if _GOES_ON.match(text, m.end()):
                continue
            digits = len(_DIGIT.findall(m.group()))
            if _IP.fullmatch(m.group()):
                found.append((1, *m.span()))
            elif 12 <= digits <= 19:
                found.append((2, *m.span()))
            elif 7 <= digits <= 11:
                found.append((3, *m.span()))
    taken, free, at = sorted((s, e) for _, s, e in base), [], 0
    for kind, start, end in sorted(found, key=lambda f: f[1:]):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        near = at
        while near < len(taken) and taken[near][0] < end and taken[near][1] <= start:
            near += 1
        apart = near == len(taken) or taken[near][0] >= end
        if apart and (not free or free[-1][2] <= start):
            free.append((kind, start, end))
    return free


def _context(text: str, start: int, end: int) -> tuple[str | None, str | None]:
    """Two whole words before and after the blank-separated word that holds the span."""
    size, before, after = _SEEN, [], []
    # the outermost part of a window may be cut off, so one more is looked for until the window is whole
    while len(before) < 4:
        before = _BLANK.split(text[max(0, start - size):start].translate(_TO_LOWER))
        if size >= start:
            break
        size *= 4
    size = _SEEN
    while len(after) < 4:
        after = _BLANK.split(text[end:end + size].translate(_TO_LOWER))
        if size >= len(text) - end:
            break
        size *= 4
    left = " ".join(before[-3:-1]) if len(before) >= 3 and before[-3] else None
    right = " ".join(after[1:3]) if len(after) >= 3 and after[2] else None
    return left, right


def _normal(kind: int, surface: str) -> str:
    """One spelling per identifier."""
    return surface.lower() if kind < 2 else "".join(_DIGIT.findall(surface))


def scan(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """`carry`, `base` spans, and every base or loose span with its `contexts`, one row per text."""
    types = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    spans_type = pa.list_(pa.struct(types))
    contexts_type = pa.list_(pa.struct([
        *types, ("surface", pa.string()), ("base", pa.bool_()), ("left", pa.string()), ("right", pa.string()),
    ]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, contexts = [], []
            for value in batch.column(0):
                body = value.as_py() or ""
                base = base_spans(body)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                both = [(*b, True) for b in base] + [(*f, False) for f in loose_spans(body, base)]
                own = []
                for kind, start, end, known in both:
                    left, right = _context(body, start, end)
                    own.append({
                        "kind": kind, "start": start, "end": end, "surface": _normal(kind, body[start:end]),
                        "base": known, "left": left, "right": right,
                    })
                contexts.append(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(spans, spans_type), pa.array(contexts, contexts_type)],
                names=[*carry, "base", "contexts"],
            )

    schema = schema_with(docs, carry, f"base array<struct<{_FOUND}>>, contexts array<{_CONTEXT}>")
    return text_first(docs, text, carry).mapInArrow(of_batches, schema)


def context_counts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """`(pair, total)`: how often each wanted pair of neighbouring words occurs in all texts."""
    worded = docs.select(split_words(ascii_lower(F.col(text))).alias("w"))
    last = F.size("w") - 2
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1)))
    pairs = worded.select(F.posexplode(hashes).alias("at", "pair"))
    kept = lookup_join(pairs, wanted.select("pair").distinct(), ["pair"], F.col("at"), "left_semi", limit=BROADCAST_HASHES)
    return kept.groupBy("pair").agg(F.count("*").alias("total"))


def _candidates(edges: DataFrame) -> DataFrame:
    """`(pattern, pair)` of the contexts that could ever be admitted.

    A pattern that holds base seeds alone cannot discover anything and needs no score; one with too few
    instances never has enough seeds.
    """
    held = edges.groupBy("pattern", "pair").agg(F.count("*").alias("n"), F.count_if(~F.col("base")).alias("unseen"))
    return materialize(held.where((F.col("n") >= LEAST_SEEDS) & (F.col("unseen") > 0)).select("pattern", "pair"), "pii-candidates")


def _supported_patterns(edges: DataFrame, scores: DataFrame, admitted: DataFrame | None) -> DataFrame:
    """`(pattern, total)` not yet admitted, with enough base or accepted instances."""
    seed = F.col("base")
    if admitted is not None:
        known = materialize(scores.where(F.col("score") >= ACCEPTED).select("instance", F.lit(True).alias("known")), "pii-known")
        edges = lookup_join(edges, known, ["instance"], F.col("pattern")).join(admitted.select("pattern"), "pattern", "left_anti")
        seed = seed | F.coalesce("known", F.lit(False))
    supported = edges.groupBy("pattern", "total").agg(F.count_if(seed).alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS)
    return materialize(supported.select("pattern", "total"), "pii-patterns")


def _rescored(graph: DataFrame, scores: DataFrame) -> DataFrame:
    """`(instance, score)` after both sides of the graph are scored once."""
    trusted = graph.join(scores, "instance").groupBy("pattern", "total").agg(
        F.sum(F.col("n") * F.col("score")).alias("good")
    )
    confidence = F.least(F.col("good") / F.greatest(F.col("total"), F.lit(1)), F.lit(0.99))
    trusted = trusted.select("pattern", confidence.alias("confidence"))
    doubt = F.sum(F.log1p(-F.col("confidence")))
    supported = graph.join(trusted, "pattern").groupBy("instance").agg(
        F.when(F.max("base"), 1.0).otherwise(1.0 - F.exp(doubt)).alias("score")
    )
    kept = scores.select("instance", F.col("score").alias("old"))
    return kept.join(supported, "instance", "left").select(
        "instance", F.coalesce("score", "old").alias("score"), "old"
    )


def discover(docs: DataFrame, text: str, occurrences: DataFrame) -> DataFrame:
    """`(kind, surface, score)` of the loose identifiers that reliable contexts support.

    Patterns are the two words before or after a span. A pattern's confidence is the summed score of
    the spans it holds, over all occurrences of the two words in all texts; an identifier's score is
    the chance that at least one of its patterns is right. Base identifiers are the seeds (score 1) and
    both sides are scored in turn, as joins of the graph's edges with the other side's scores. Accepted
    identifiers are seeds of further patterns, until a generation adds no pattern and no identifier.
    """
    name = F.concat_ws(":", F.col("kind").cast("string"), "surface")
    side = F.explode(F.array(
        F.struct(F.lit("L").alias("side"), F.col("left").alias("words")),
        F.struct(F.lit("R").alias("side"), F.col("right").alias("words")),
    ))
    sided = occurrences.select("kind", name.alias("instance"), "base", side.alias("p")).where(F.col("p.words").isNotNull())
    pattern = F.concat_ws(" ", F.col("kind").cast("string"), "p.side", "p.words")
    words = F.split(F.col("p.words"), " ")
    edges = sided.select(
        pattern.alias("pattern"), F.xxhash64(F.get(words, 0), F.get(words, 1)).alias("pair"), "instance", "base"
    ).groupBy("pattern", "pair", "instance").agg(F.count("*").alias("n"), F.max("base").alias("base"))
    edges = materialize(edges, "pii-edges")
    candidates = _candidates(edges)
    if candidates.isEmpty():
        none = edges.where(F.lit(False))
        return none.select(F.lit(0).alias("kind"), F.col("instance").alias("surface"), F.lit(1.0).alias("score"))
    totals = candidates.join(context_counts(docs, text, candidates), "pair").select("pattern", "total")
    edges = materialize(edges.drop("pair").join(totals, "pattern"), "pii-edges")
    scores = materialize(edges.groupBy("instance").agg(F.max(F.col("base").cast("double")).alias("score")), "pii-scores")
    accepted, admitted, grown = scores.where(F.col("score") >= ACCEPTED).count(), None, False
    while True:
        new = _supported_patterns(edges, scores, admitted)
        if new.isEmpty():
            if not grown:
                break
        else:
            admitted = new if admitted is None else materialize(admitted.unionByName(new), "pii-patterns")
            graph = materialize(edges.join(admitted.select("pattern"), "pattern"), "pii-graph")
        # scores only grow, up to 1, so they settle
        moved = 1.0
        while moved > SETTLED:
            scores = materialize(_rescored(graph, scores), "pii-scores")
            moved = scores.agg(F.max(F.col("score") - F.col("old"))).first()[0] or 0.0
        before, accepted = accepted, scores.where(F.col("score") >= ACCEPTED).count()
        grown = accepted > before
    found = scores.where(F.col("score") >= ACCEPTED)
    parts = F.split(F.col("instance"), ":", 2)
    return found.select(F.get(parts, 0).cast("int").alias("kind"), F.get(parts, 1).alias("surface"), "score")


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, base, found)`, one row per input row: spans `(kind, start, end)` in code points.

    `base` holds the exact forms; `found` the further identifiers accepted by `discover`, which never
    overlap a base span. Kinds are numbered as in `KINDS`. Null and empty text has no spans. Repeated
    rows and equal texts get equal spans, null keys are rows like others, an empty table gives an empty
    table. Other columns are not carried, so clashing names do not matter.

    Very long texts, words and forms are read whole, in place: once for spans, and once to count the words
    around those contexts that hold a loose form. What is shuffled are spans and their contexts.
    """
    rows = with_row_hash(docs.select(key, text), text)
    scanned = materialize(scan(rows, text, [key, "_row"]), "pii-scan")
    occurrences = scanned.select(F.col(key).alias("_id"), "_row", F.explode("contexts").alias("c")).select(
        "_id", "_row", "c.*"
    )
    loose = occurrences.where(~F.col("base"))
    found = discover(rows, text, occurrences)
    spans = loose.join(found.select("kind", "surface"), ["kind", "surface"]).groupBy("_id", "_row").agg(
        F.collect_set(F.struct("kind", "start", "end")).alias("_more")
    )
    joined = join_by_row(scanned.select(key, "_row", "base"), spans, key, ["_more"])
    none = F.array().cast(f"array<struct<{_FOUND}>>")
    return joined.select(key, "base", F.coalesce("_more", none).alias("found"))


def span_list(spans: Column) -> Column:
    """`kind:start:end` by start, then kind, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
