"""Language identification: mixtures of languages from n-gram likelihoods by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import schema_with, text_first

#: Labelled documents per language that the n-gram counts are learnt from, about.
SAMPLE_DOCUMENTS = 5000
BUCKETS = 1 << 16
SMOOTHING = 0.2
ITERATIONS = 12
#: Cost of one more language, in units of half the logarithm of the number of words.
PENALTY = 4.0
UNKNOWN = "und"
_CHUNK_CELLS = 4_000_000
_IS_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])


@dataclass
class LanguageModel:
    languages: list[str]
    log_share: np.ndarray  # (BUCKETS, languages): log of each n-gram's share in a language


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(4)) == 2


def word_trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """`(buckets, starts)`: a bucket per letter, from it and its neighbours within the word.

    Words are runs of letters, lower-cased; `starts` is the position of each word's first letter.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = _IS_LETTER[np.minimum(codes, 0xFFFF)]
    for code in np.unique(codes[codes > 0xFFFF]):
        letter = np.where(codes == code, chr(code).isalpha(), letter)
    after = np.r_[False, letter[:-1]]
    kept = letter | after  # the letters, and one gap behind each word
    gapped = np.r_[0, np.where(letter, codes, 0)[kept], 0].astype(np.uint32)
    middle = np.flatnonzero(gapped)
    mixed = gapped[middle - 1] * np.uint32(2654435761) + gapped[middle] * np.uint32(2246822519)
    mixed += gapped[middle + 1] * np.uint32(3266489917)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(668265263)
    return (mixed >> np.uint32(16)).astype(np.int64), np.flatnonzero(gapped[middle - 1] == 0)


def _pieces(text: str, size: int) -> Iterator[str]:
    """The whole text in pieces of at most `size` characters, cut at blanks where there are any."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            blank = text.rfind(" ", at, end)
            end = blank + 1 if blank > at else end
        yield text[at:end]
        at = end


def fit(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: int = SAMPLE_DOCUMENTS,
) -> LanguageModel:
    """Learn n-gram shares from documents with a language that are not held out.

    Of each language about `sample` documents are used, those with the smallest hash of the key (all
    if it has fewer). The driver receives at most 65,536 counts per language.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    sizes = {r[lang]: r["count"] for r in usable.groupBy(lang).count().collect()}
    share = F.lit(0.0)
    for name, n in sorted(sizes.items()):
        share = F.when(F.col(lang) == name, min(1.0, sample / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("language"), F.col(key)), F.lit(1 << 30)) < share * (1 << 30)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                for piece in _pieces(value.as_py(), _CHUNK_CELLS // 8):
                    own += np.bincount(word_trigrams(piece)[0], minlength=BUCKETS)
        for name, own in counts.items():
            held = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(held)), pa.array(held), pa.array(own[held])], names=["lang", "bucket", "n"]
            )

    counted = usable.where(drawn).select(lang, text).mapInArrow(of_batches, "lang string, bucket long, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    counts[table["bucket"], np.searchsorted(languages, table["lang"])] += table["n"]
    return LanguageModel([str(x) for x in languages], np.log(counts / counts.sum(axis=0)).astype(np.float32))


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", carry: list[str] | None = None,
) -> DataFrame:
    """Add `lang_pred`, `score` and `languages` (name and share of each language in the chosen set).

    Input columns of these names give way, all others (or only those in `carry`) stay. `lang_pred` is the language with the largest
    share of the words and `score` that share. Null, empty and blank text, text without a letter, and
    any text when no language was learnt is `und` with score 0 and no languages. Repeated rows get equal
    results; ties go to the language first by name. An empty table gives an empty table.

    Every text is read whole, in pieces of bounded size; nothing is shuffled. The model, a table of
    65,536 rows per learnt language, is the only thing broadcast.
    """
    docs = docs.drop("lang_pred", "score", "languages")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    carried = [c for c in (docs.columns if carry is None else carry) if c in docs.columns]
    languages_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            predicted, scores, sets = [], [], []
            for shares in _mixtures(own, batch.column(0)):
                best = int(np.argmax(shares)) if shares is not None else 0
                known = shares is not None
                predicted.append(own.languages[best] if known else UNKNOWN)
                scores.append(min(1.0, float(shares[best])) if known else 0.0)
                held = np.flatnonzero(shares) if known else []
                sets.append([{"lang": own.languages[i], "share": float(shares[i])} for i in held])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(predicted, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, languages_type)],
                names=[*carried, "lang_pred", "score", "languages"],
            )

    return text_first(docs, text, carried).mapInArrow(of_batches, schema_with(docs, carried, found))


def _mixtures(model: LanguageModel, texts: pa.Array) -> Iterator[np.ndarray | None]:
    """The language shares of each text, or None for a text without a letter; some texts at a time."""
    size = max(1, _CHUNK_CELLS // (4 * max(1, len(model.languages))))
    waiting, cells = [], 0
    for value in texts:
        text = value.as_py() or ""
        parts = [_word_likelihoods(model, p) for p in _pieces(text, size)] if model.languages else []
        words = np.concatenate(parts) if parts else np.zeros((0, len(model.languages)), np.float32)
        waiting.append(words)
        cells += words.size
        if cells >= _CHUNK_CELLS // 4:
            yield from _shares(waiting)
            waiting, cells = [], 0
    yield from _shares(waiting)


def _word_likelihoods(model: LanguageModel, text: str) -> np.ndarray:
    buckets, starts = word_trigrams(text)
    if not len(buckets):
        return np.zeros((0, len(model.languages)), np.float32)
    return np.add.reduceat(model.log_share[buckets], starts, axis=0)


def _shares(documents: list[np.ndarray]) -> Iterator[np.ndarray | None]:
    held = [d for d in documents if len(d)]
    shares = iter(language_shares(np.concatenate(held), np.array([len(d) for d in held]))) if held else iter(())
    for d in documents:
        yield next(shares) if len(d) else None


def language_shares(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """`(documents, languages)` shares, zero outside the chosen set of each document.

    `words` holds the log-likelihood of every word in every language, `sizes` the words per document.
    Languages join the set in the order of their share in the full mixture, as long as the likelihood
    grows by more than the penalty; a language that explains less than half a word cannot.
    """
    n, width = len(sizes), words.shape[1]
    full, _ = _mixture(words, sizes, np.ones((n, width), bool))
    order = np.argsort(-full, axis=1, kind="stable")
    chosen = np.zeros((n, width), bool)
    chosen[np.arange(n), order[:, 0]] = True
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    doc = np.repeat(np.arange(n), sizes)
    likelihood = np.add.reduceat(words[np.arange(len(words)), order[doc, 0]].astype(np.float64), starts)
    shares = chosen.astype(np.float64)
    open_ones = np.arange(n)
    for rank in range(1, width):
        candidate = order[open_ones, rank]
        open_ones = open_ones[full[open_ones, candidate] * sizes[open_ones] >= 0.5]
        if not len(open_ones):
            break
        wider = chosen[open_ones]
        wider[np.arange(len(open_ones)), order[open_ones, rank]] = True
        of_open = np.zeros(n, bool)
        of_open[open_ones] = True
        mixed, value = _mixture(words[of_open[doc]], sizes[open_ones], wider)
        gain = value - likelihood[open_ones]
        better = gain > PENALTY * 0.5 * np.log(sizes[open_ones] + 1.0)
        open_ones, wider, mixed, value = open_ones[better], wider[better], mixed[better], value[better]
        chosen[open_ones], shares[open_ones], likelihood[open_ones] = wider, mixed, value
    return shares


def _mixture(words: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages, and the likelihood that they reach."""
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    masked = np.where(allowed[doc], words, -np.inf)
    top = masked.max(axis=1)
    relative = np.exp(masked - top[:, None])
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ITERATIONS):
        weight = relative * shares[doc]
        weight /= weight.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(weight, starts, axis=0) / sizes[:, None]
    reached = np.log((relative * shares[doc]).sum(axis=1)) + top
    return shares, np.add.reduceat(reached.astype(np.float64), starts)
