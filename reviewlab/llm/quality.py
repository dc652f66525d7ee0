"""Quality rules: document statistics, fixed limits, and boosted trees learnt from labels."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm import boosting
from reviewlab.llm.rows import schema_with, text_first

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Labelled documents that the trees are fitted on, about; the driver receives one row of numbers each.
SAMPLE_DOCUMENTS = 20_000
LEAST_EXAMPLES = 40
THRESHOLD = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_digits", "n_stops", "n_shouts"]
#: Features of the trees; +1 (-1): more of it never lowers (raises) the score.
SIGNS = {
    "log_words": 0, "word_length": 0, "symbols": -1, "duplicate_lines": -1, "repeated_words": -1,
    "words_per_line": 0, "upper": -1, "digits": -1, "stops": 0, "shouts": -1,
}
_WEIGHTS = {name: np.zeros(256, bool) for name in ("blank", "symbol", "upper", "digit", "stop", "shout")}
for _name, _characters in {
    "blank": b" \t\n\x0b\f\r", "symbol": b"#*$%&|<>", "upper": bytes(range(65, 91)),
    "digit": b"0123456789", "stop": b".,;:", "shout": b"!?",
}.items():
    _WEIGHTS[_name][list(_characters)] = True


def text_counts(text: str | None) -> list[int]:
    """The numbers of `COUNTS` and `EXTRA` for one whole text; null has none."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    of = {k: int(np.bincount(np.frombuffer(raw, np.uint8), minlength=256)[w].sum()) for k, w in _WEIGHTS.items()}
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return [
        len(words), len(text) - of["blank"], of["symbol"], len(lines) - len(set(lines)), repeated_words(words),
        len(lines), of["upper"], of["digit"], of["stop"], of["shout"],
    ]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds more than once, the first time included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    inside = bytearray(len(words))
    for at, window in enumerate(windows):
        if times[window] > 1:
            inside[at:at + 3] = b"\x01\x01\x01"
    return sum(inside)


def features(counts: np.ndarray) -> np.ndarray:
    """Rows of `SIGNS` from rows of `COUNTS` and `EXTRA`."""
    words, chars, symbols, duplicates, repeated, lines, upper, digits, stops, shouts = counts.astype(float).T
    per_word, per_char, per_line = (np.maximum(x, 1) for x in (words, chars, lines))
    return np.stack([
        np.log1p(words), chars / per_word, symbols / per_char, duplicates / per_line, repeated / per_word,
        words / per_line, upper / per_char, digits / per_char, stops / per_word, shouts / per_word,
    ], axis=1)


def fit_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality",
    sample: int = SAMPLE_DOCUMENTS,
) -> boosting.Forest | None:
    """Trees from about `sample` labelled documents (those with the smallest hash of the key).

    A key labelled both ways counts as bad; null keys and labels are left out; of documents that share
    a key any one is used. None when either class has fewer than 40 examples.
    """
    known = labels.where(F.col(quality).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.col(quality).cast("int")).alias("_good")
    )
    share = min(1.0, sample / max(1, known.count()))
    drawn = F.pmod(F.xxhash64(F.lit("quality"), F.col(key)), F.lit(1 << 30)) < share * (1 << 30)
    # about `sample` rows of two numbers, whatever the size of the tables
    chosen = F.broadcast(known.where(drawn))
    joined = docs.select(key, text).join(chosen, key)
    counted = text_statistics(joined, text, ["_good", key]).dropDuplicates([key])
    table = counted.select("_good", *COUNTS, *EXTRA).toPandas()
    good = table["_good"].to_numpy(float)
    if min(good.sum(), len(good) - good.sum()) < LEAST_EXAMPLES:
        return None
    rows = features(table[COUNTS + EXTRA].to_numpy())
    return boosting.fit(rows, good, np.array(list(SIGNS.values())))


def text_statistics(
    docs: DataFrame, text: str, carry: list[str], forest: boosting.Forest | None = None,
) -> DataFrame:
    """`carry`, the counts, and `score` (null without trees), one row per input row; nothing moves."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    numbers = COUNTS + EXTRA
    schema = schema_with(docs, carry, ", ".join([f"{c} long" for c in numbers] + ["score double"]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            counts = np.array([text_counts(v.as_py()) for v in batch.column(0)], np.int64).reshape(-1, len(numbers))
            scores = pa.array(trees.score(features(counts))) if trees else pa.nulls(len(counts), pa.float64())
            columns = [*batch.columns[1:], *[pa.array(counts[:, i]) for i in range(len(numbers))], scores]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *numbers, "score"])

    return text_first(docs, text, carry).mapInArrow(of_batches, schema)


def judge_quality(
    docs: DataFrame, forest: boosting.Forest | None, text: str = "text", carry: list[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Add the counts, `score`, `base_failed` and `kept`.

    Input columns of these names give way, all others (or only those in `carry`) stay. A document fails
    the base rules with fewer than 50 words or with more than half of its words in repeated three-word
    windows; one that passes is kept if the trees give it `threshold` or more, or if there are no trees.
    Null, empty and blank text has no words and fails. Repeated rows get equal results; an empty table
    gives an empty table. Every text is counted whole.
    """
    own = [*COUNTS, *EXTRA, "score", "base_failed", "kept"]
    carried = [c for c in (docs.columns if carry is None else carry) if c in docs.columns and c not in own]
    judged = text_statistics(docs, text, carried, forest)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(1.0)) >= threshold)
    )
