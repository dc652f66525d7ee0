"""Token-level tables: sentences, tokens, rule-based annotations and noun phrases.

The annotations contract is one row per token:
`(doc_id, sentence_idx, token_idx, token, pos, dep_label, head_idx, head)`; `head_idx` is the
position in the same sentence, -1 when there is no head. A parser's output fits it directly;
`annotate_by_rules` fills it from word cues when there is none.

Annotations may also lie in one row per document, `(doc_id, token, pos, dep_label, head_idx, head)`, where each
of the last five is an array per sentence of its tokens' values (`document_annotations`). The operators below take
both forms; of the second only documents whose id repeats are taken apart into rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.text import sentence_tokens, sentences
from reviewlab.operators.lookup import by_repetition, lookup_join, repeated_keys

TOKEN_KEY = ["doc_id", "sentence_idx", "token_idx"]


def sentence_table(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select(
        "doc_id", F.posexplode(sentences(F.col(text))).alias("sentence_idx", "text")
    )


def _by_sentence(df: DataFrame, text: str, of_tokens: Callable[[Column], Column]) -> DataFrame:
    """One row per sentence with an array computed from its tokens."""
    arrays = F.transform(sentence_tokens(F.col(text)), of_tokens)
    return df.select("doc_id", F.posexplode(arrays).alias("sentence_idx", "_items"))


def token_table(df: DataFrame, text: str = "text") -> DataFrame:
    return _by_sentence(df, text, lambda t: t).select(
        "doc_id", "sentence_idx", F.posexplode("_items").alias("token_idx", "token")
    )


def document_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """`token_table` in one row per document: `(doc_id, token)`, an array per sentence."""
    return df.select("doc_id", sentence_tokens(F.col(text)).alias("token"))


def with_following(token_array: Column) -> Column:
    """Pairs `(token, following)`; the last token has none. Keeps the array out of exploded rows."""
    following = F.slice(token_array, 2, F.greatest(F.size(token_array), F.lit(1)))
    return F.zip_with(
        token_array, following, lambda t, f: F.struct(t.alias("token"), f.alias("following"))
    )


def annotate_by_rules(
    df: DataFrame,
    text: str = "text",
    negation_cues: Iterable[str] = fv.NEGATION_CUES,
    degree_words: Iterable[str] = (*fv.INTENSIFIERS, *fv.MITIGATORS),
    pos_of: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Cue words as dependencies: a negation or degree word points at the next token."""
    rows = (
        _by_sentence(df, text, with_following)
        .select("doc_id", "sentence_idx", F.posexplode("_items").alias("token_idx", "_item"))
        .select("doc_id", "sentence_idx", "token_idx", "_item.token", "_item.following")
        .withColumn("dep_label", _cue_label(F.col("token"), negation_cues, degree_words))
    )
    has_head = (F.col("dep_label") != "unknown") & F.col("following").isNotNull()
    return rows.select(
        *TOKEN_KEY,
        "token",
        (pos_of(F.col("token")) if pos_of else F.lit("")).alias("pos"),
        "dep_label",
        F.when(has_head, F.col("token_idx") + 1).otherwise(-1).alias("head_idx"),
        F.when(has_head, F.col("following")).otherwise("").alias("head"),
    )


def _cue_label(token: Column, negation_cues: Iterable[str], degree_words: Iterable[str]) -> Column:
    word = F.lower(token)
    return (
        F.when(word.isin(list(negation_cues)), "neg")
        .when(word.isin(list(degree_words)), "advmod")
        .otherwise("unknown")
    )


def document_annotations(
    df: DataFrame,
    text: str = "text",
    negation_cues: Iterable[str] = fv.NEGATION_CUES,
    degree_words: Iterable[str] = (*fv.INTENSIFIERS, *fv.MITIGATORS),
    pos_of: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """`annotate_by_rules` in one row per document, where the text lies: nothing is taken apart or moved."""
    def each(of_token: Callable[..., Column]) -> Callable[[Column], Column]:
        return lambda sentence: F.transform(sentence, of_token)

    # arrays go side by side, not by position: a column that is looked up within a lambda may be computed per element
    def heads(labels: Column, sentence: Column) -> Column:
        return F.transform(labels, lambda label, i: F.when((label != "unknown") & F.get(sentence, i + 1).isNotNull(), i + 1).otherwise(-1))

    def head_words(positions: Column, sentence: Column) -> Column:
        return F.transform(positions, lambda i: F.when(i >= 0, F.get(sentence, i)).otherwise(""))

    rows = df.select("doc_id", sentence_tokens(F.col(text)).alias("token"))
    rows = rows.withColumn("pos", F.transform("token", each(pos_of or (lambda t: F.lit("")))))
    rows = rows.withColumn("dep_label", F.transform("token", each(lambda t: _cue_label(t, negation_cues, degree_words))))
    return rows.withColumn("head_idx", F.zip_with("dep_label", "token", heads)).withColumn("head", F.zip_with("head_idx", "token", head_words))


def in_documents(annotations: DataFrame) -> bool:
    """Whether annotations (or tokens) lie in one row per document."""
    return dict(annotations.dtypes)["token"].startswith("array")


def token_rows(annotations: DataFrame) -> DataFrame:
    """Annotations in document rows as one row per token."""
    names = [c for c in annotations.columns if c != "doc_id"]
    sentence = annotations.select("doc_id", F.posexplode(F.arrays_zip(*names)).alias("sentence_idx", "_s"))
    tokens = F.arrays_zip(*[F.col(f"_s.{c}").alias(c) for c in names])
    return sentence.select("doc_id", "sentence_idx", F.posexplode(tokens).alias("token_idx", "_t")).select(*TOKEN_KEY, "_t.*")


def dependency_table(annotations: DataFrame) -> DataFrame:
    """Annotations as stored: missing text is empty, a missing head is -1."""
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ("token", "pos", "dep_label")]
    return annotations.select(
        *TOKEN_KEY,
        *filled,
        F.coalesce("head_idx", F.lit(-1)).alias("head_idx"),
        F.coalesce("head", F.lit("")).alias("head"),
    )


def fill_heads(annotations: DataFrame) -> DataFrame:
    """Set `head` to the token at `head_idx`, for parser output that gives positions only.

    A self-join within the sentence, of the rows that have a head. Positions outside the sentence
    find no token and leave the head empty. Of annotations in document rows each head is looked up in its
    sentence where it lies. The result has one row per token.
    """
    if in_documents(annotations):
        once, repeated = by_repetition(annotations, "doc_id")

        def heads(positions: Column, sentence: Column) -> Column:
            return F.transform(positions, lambda i: F.coalesce(F.when(i >= 0, F.get(sentence, i)), F.lit("")))

        return token_rows(once.withColumn("head", F.zip_with("head_idx", "token", heads))).unionByName(fill_heads(token_rows(repeated)))
    tokens = annotations.select(
        "doc_id", "sentence_idx", F.col("token_idx").alias("head_idx"), F.col("token").alias("_head")
    )
    pointing = annotations.where(F.col("head_idx") >= 0).select(*TOKEN_KEY, "head_idx")
    found = pointing.join(tokens, ["doc_id", "sentence_idx", "head_idx"]).select(*TOKEN_KEY, "_head")
    joined = annotations.drop("head").join(found, TOKEN_KEY, "left")
    return joined.withColumn("head", F.coalesce("_head", F.lit(""))).select(*annotations.columns)


def token_pos_join(tokens: DataFrame, annotations: DataFrame) -> DataFrame:
    """Attach part-of-speech tags to tokens by position.

    Where both lie in document rows, these are joined and the tags put beside the tokens in the row; what moves
    are the tokens and the tags alone. Documents that are annotated more than once are joined token by token.
    """
    if in_documents(tokens) and in_documents(annotations):
        return _document_tags(tokens, annotations)
    tags = annotations.select(*TOKEN_KEY, F.col("pos").alias("pos_tag"))
    return tokens.join(tags, TOKEN_KEY, "left")


def _document_tags(tokens: DataFrame, annotations: DataFrame) -> DataFrame:
    keys = repeated_keys(annotations, "doc_id")
    tags = lookup_join(annotations.select("doc_id", F.col("pos").alias("_tags")), keys, ["doc_id"], F.col("doc_id"), "left_anti")
    joined = lookup_join(tokens, keys, ["doc_id"], F.col("doc_id"), "left_anti").join(tags, "doc_id", "left")

    def beside(sentence: Column, tags_of: Column) -> Column:
        return F.transform(sentence, lambda token, i: F.get(tags_of, i))

    # tags may be longer or shorter than the tokens, or missing
    as_long = F.slice(F.coalesce("_tags", F.array().cast("array<array<string>>")), F.lit(1), F.size("token"))
    once = token_rows(joined.select("doc_id", "token", F.zip_with("token", as_long, beside).alias("pos_tag")))
    again = [token_rows(lookup_join(df, keys, ["doc_id"], F.col("doc_id"), "left_semi")) for df in (tokens, annotations)]
    return once.unionByName(token_pos_join(*again))


_FIELD, _END = "\u0001", "\u0002"


def noun_phrases(annotations: DataFrame) -> DataFrame:
    """Determiner? adjective* noun+ runs per sentence.

    Each sentence is spelled as `class FIELD token END ...` and searched with one expression, so
    the match already holds the words.
    """
    if in_documents(annotations):
        once, repeated = by_repetition(annotations, "doc_id")

        def spelled_out(sentence: Column, tags: Column) -> Column:
            return F.array_join(F.zip_with(sentence, tags, _unit), "")

        sentences_of = once.select("doc_id", F.posexplode(F.zip_with("token", "pos", spelled_out)).alias("sentence_idx", "spelled"))
        return _phrases(sentences_of).unionByName(noun_phrases(token_rows(repeated)))
    unit = _unit(F.col("token"), F.col("pos"))
    spelled = annotations.groupBy("doc_id", "sentence_idx").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("token_idx", unit.alias("unit")))),
                lambda item: item["unit"],
            ),
            "",
        ).alias("spelled")
    )
    return _phrases(spelled)


def _unit(token: Column, pos: Column) -> Column:
    kind = F.when(pos == "DT", "D").when(pos == "JJ", "J").when(F.startswith(pos, F.lit("NN")), "N").otherwise("O")
    return F.concat(kind, F.lit(_FIELD), token, F.lit(_END))


def _phrases(spelled: DataFrame) -> DataFrame:
    """The phrases of `(doc_id, sentence_idx, spelled)`."""
    def one(letter: str) -> str:
        return rf"{letter}\x{{1}}[^\x{{2}}]*\x{{2}}"

    # possessive repeats: nothing to give back, and no recursion per repeat on long runs
    pattern = f"(?:{one('D')})?(?:{one('J')})*+(?:{one('N')})++"
    found = spelled.select(
        "doc_id",
        "sentence_idx",
        F.posexplode(F.regexp_extract_all("spelled", F.lit(pattern), F.lit(0))).alias(
            "phrase_idx", "raw"
        ),
    )
    words = F.rtrim(F.regexp_replace(F.regexp_replace("raw", r"[DJN]\x{1}", ""), r"\x{2}", " "))
    return found.select("doc_id", "sentence_idx", "phrase_idx", words.alias("phrase"))
