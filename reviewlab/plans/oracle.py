"""The registered queries once more, as plain SQL over the same tables (DuckDB dialect)."""

from __future__ import annotations

import math

from reviewlab.functions import fixed_values as fv
from reviewlab.functions import stems
from reviewlab.functions.cleaning import stopwords
from reviewlab.operators import normalization
from reviewlab.plans import fixtures as fx


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


def one_of(words) -> str:
    return "(" + ", ".join(text(w) for w in words) + ")"


WS = text(fv.WHITESPACE_CHARS)
POSITIVE = [w for w, v in fx.LEXICON if v > 0]
NEGATIVE = [w for w, v in fx.LEXICON if v < 0]

# --- views ------------------------------------------------------------------------------------

REVIEWS = f"""reviews AS (
  SELECT doc_id AS row_id, source AS game_id, lang AS "user", text, {fx.RATING_SQL} AS rating
  FROM documents)"""

KEPT = f"""kept AS (
  SELECT row_id, game_id, "user", trim(text, {WS}) AS text, rating FROM reviews
  WHERE rating IS NOT NULL AND length(trim(text, {WS})) >= 10)"""

BANDS3 = """CASE WHEN rating BETWEEN 7.0::DOUBLE AND 10.0::DOUBLE THEN 'positive'
  WHEN rating BETWEEN 5.0::DOUBLE AND 6.99::DOUBLE THEN 'neutral'
  WHEN rating BETWEEN 0.0::DOUBLE AND 4.99::DOUBLE THEN 'negative' END"""

CORPUS = f"""{REVIEWS}, {KEPT}, corpus AS (
  SELECT row_id AS doc_id, game_id, "user", text, rating, {BANDS3} AS label FROM kept)"""

RATINGS = """ratings AS (
  SELECT event_id AS row_id, event_type AS game_id, CAST(user_id AS VARCHAR) AS "user", ts,
    CAST(event_id % 21 AS DOUBLE) / CAST(2 AS DOUBLE) AS rating FROM events)"""

PREDICTIONS = """predictions AS (
  SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'test' WHEN doc_id % 5 = 1 THEN 'validation' ELSE 'train' END AS "set",
    CASE doc_id % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS label,
    CASE (doc_id + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END) % 3
      WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS prediction FROM documents)"""


def tokens(expr: str) -> str:
    return (
        f"regexp_extract_all(regexp_replace({expr}, {text(fv.CLITIC_NEGATION)}, '\\1 \\2', 'g'), "
        f"{text(fv.TOKEN)})"
    )


def sentences(expr: str) -> str:
    marked = f"regexp_replace({expr}, {text('([.!?])' + fv.WHITESPACE_CLASS + '+')}, '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: length(s) > 0)"


def words(expr: str) -> str:
    return f"regexp_extract_all(strip_accents(lower({expr})), {text(fv.WORD)})"


def grams(array: str, n: int) -> str:
    return f"list_transform(range(1, len({array}) - {n - 2}), lambda i: array_to_string({array}[i:i+{n - 1}], ' '))"


def token_rows(source: str, name: str = "tok") -> str:
    """One row per sentence token with the token that follows in the sentence."""
    return f"""{name}_s AS (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) - 1 AS sentence_idx
    FROM (SELECT doc_id, {sentences('text')} AS s FROM {source})),
  {name}_t AS (SELECT doc_id, sentence_idx, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS token_idx
    FROM (SELECT doc_id, sentence_idx, {tokens('s')} AS t FROM {name}_s)),
  {name} AS (SELECT doc_id, sentence_idx, token_idx, token, lead(token) OVER
    (PARTITION BY doc_id, sentence_idx ORDER BY token_idx) AS following FROM {name}_t)"""


POS = f"""CASE WHEN lower(token) IN {one_of(fx.DETERMINERS)} THEN 'DT' WHEN suffix(token, 'e') THEN 'JJ'
  WHEN length(token) >= 4 AND regexp_matches(token, '^\\p{{L}}') THEN 'NN' ELSE 'X' END"""


def annotations(source: str) -> str:
    return f"""{token_rows(source)}, marked AS (SELECT *, {POS} AS pos,
    CASE WHEN lower(token) IN {one_of(fx.CUES)} THEN 'neg'
      WHEN lower(token) IN {one_of(fx.STRONG + fx.WEAK)} THEN 'advmod' ELSE 'unknown' END AS dep_label FROM tok),
  annotations AS (SELECT doc_id, CAST(sentence_idx AS BIGINT) AS sentence_idx, CAST(token_idx AS BIGINT) AS token_idx,
    token, pos, dep_label,
    CAST(CASE WHEN dep_label <> 'unknown' AND following IS NOT NULL THEN token_idx + 1 ELSE -1 END AS BIGINT) AS head_idx,
    CASE WHEN dep_label <> 'unknown' AND following IS NOT NULL THEN following ELSE '' END AS head FROM marked)"""


LEXICON = "lexicon(term, valence) AS (VALUES " + ", ".join(f"({text(w)}, {v}::DOUBLE)" for w, v in fx.LEXICON) + ")"

DERIVED_LEXICON = f"""derived AS (SELECT term, CAST(length(term) % 3 - 1 AS DOUBLE) AS valence
  FROM (SELECT DISTINCT unnest({tokens('lower(text)')}) AS term FROM documents))"""

FORMS = f"""bench AS (SELECT DISTINCT term FROM (SELECT unnest({tokens('lower(text)')}) AS term FROM benchmark)
    WHERE length(term) >= 5),
  forms AS (SELECT term, left(term, length(term) - 2) AS normal_form FROM bench),
  forms_pos AS (SELECT term, 'n' AS pos_class, left(term, length(term) - 2) AS normal_form FROM bench
    UNION ALL SELECT term, 'a', left(term, length(term) - 4) FROM bench)"""


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / greatest({whole}, 1)"


def features_from(source: str) -> str:
    """The 23 features as plain counts over the token rows."""
    return f"""{LEXICON}, {token_rows(source)}, counted AS (
    SELECT doc_id, CAST(count(*) AS BIGINT) AS n,
      count(*) FILTER (WHERE lower(token) IN {one_of(POSITIVE)}) AS p,
      count(*) FILTER (WHERE lower(token) IN {one_of(NEGATIVE)}) AS q,
      count(*) FILTER (WHERE lower(token) IN {one_of(fx.DOMAIN)}) AS d,
      count(*) FILTER (WHERE lower(token) IN {one_of(fx.CUES)}) AS c,
      count(*) FILTER (WHERE lower(token) IN {one_of(fx.CUES)} AND lower(following) IN {one_of(POSITIVE + NEGATIVE)}) AS co,
      count(*) FILTER (WHERE lower(token) IN {one_of(fx.STRONG)}) AS i,
      count(*) FILTER (WHERE lower(token) IN {one_of(fx.WEAK)}) AS m,
      coalesce(sum(l.valence), 0.0::DOUBLE) AS v
    FROM tok LEFT JOIN lexicon l ON lower(token) = l.term GROUP BY doc_id),
  base AS (SELECT b.*, length(text) AS tl, len({sentences('text')}) AS sc,
      coalesce(n, 0) AS n, coalesce(p, 0) AS p, coalesce(q, 0) AS q, coalesce(d, 0) AS d, coalesce(c, 0) AS c,
      coalesce(co, 0) AS co, coalesce(i, 0) AS i, coalesce(m, 0) AS m, coalesce(v, 0.0::DOUBLE) AS v
    FROM {source} b LEFT JOIN counted USING (doc_id)),
  exact AS (SELECT doc_id, label, CAST(p AS BIGINT) AS positive_word_count, CAST(q AS BIGINT) AS negative_word_count,
      {ratio('p - q', 'n')} AS opinion_word_ratio,
      CAST(c AS BIGINT) AS negation_count, c > 0 AS has_negation, CAST(co AS BIGINT) AS negated_opinion_words,
      CAST(i AS BIGINT) AS intensifier_count, CAST(m AS BIGINT) AS mitigator_count, i > 0 AS has_intensifier,
      m > 0 AS has_mitigator, CAST(d AS BIGINT) AS domain_word_count, {ratio('d', 'n')} AS domain_word_ratio,
      d > 0 AS has_domain_words, (p + q > 0) AND d > 0 AS domain_opinion_overlap,
      CAST(tl AS BIGINT) AS text_length, CAST(sc AS BIGINT) AS sentence_count, CAST(n AS BIGINT) AS token_count,
      {ratio('n', 'sc')} AS avg_sentence_length, rating,
      v / sqrt(v * v + 15.0::DOUBLE) AS vader_compound, {ratio('p', 'n')} AS vader_positive,
      {ratio('q', 'n')} AS vader_negative,
      CASE WHEN n > 0 THEN {ratio('n - p - q', 'n')} ELSE 0.0::DOUBLE END AS vader_neutral
    FROM base)"""


_DOUBLES = (
    "opinion_word_ratio", "domain_word_ratio", "avg_sentence_length", "rating", "vader_compound",
    "vader_positive", "vader_negative", "vader_neutral",
)
FEATURE_SELECT = "doc_id, label, " + ", ".join(
    f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in fv.FEATURE_COLUMNS
)


def ranked(source: str) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id),
      CAST(doc_id AS VARCHAR)) - 1 AS r, count(*) OVER (PARTITION BY label) AS n
    FROM {source} WHERE label IS NOT NULL)"""


def split(source: str, test: str, validation: str, of_rest: bool = False) -> str:
    t = f"CAST(floor(n * {test}::DOUBLE) AS BIGINT)"
    base = f"(n - {t})" if of_rest else "n"
    v = f"CAST(floor({base} * {validation}::DOUBLE) AS BIGINT)"
    return f"""{ranked(source)}, split AS (SELECT *, CASE WHEN r < {t} THEN 'test' WHEN r < {t} + {v}
      THEN 'validation' ELSE 'train' END AS "set" FROM ranked)"""


_BY_ORDER = "by n-gram order"


def vocabulary(n: int, limit: int | str | None = _BY_ORDER, source: str = "documents",
               min_df: str = str(fv.MIN_DF), max_df: str = f"{fv.MAX_DF}::DOUBLE * (SELECT count(*) FROM documents)") -> str:
    """Views w (words), gram, dt (counts per document), terms."""
    lists = " UNION ALL ".join(f"SELECT doc_id, unnest({grams('w', k)}) AS term FROM w" for k in range(1, n + 1))
    limit = fv.NGRAM_FEATURES[n] if limit == _BY_ORDER else limit
    cut = f"ORDER BY tf DESC, term LIMIT {limit}" if limit else ""
    total = f"(SELECT count(*) FROM {source})"
    return f"""w AS (SELECT doc_id, {words('text')} AS w FROM {source}), gram AS ({lists}),
  dt AS (SELECT doc_id, term, count(*) AS tf FROM gram GROUP BY ALL),
  stats AS (SELECT term, count(*) AS df, sum(tf) AS tf FROM dt GROUP BY term
    HAVING count(*) >= {min_df} AND count(*) <= {max_df} {cut}),
  terms AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, CAST(df AS BIGINT) AS df,
    CAST(tf AS BIGINT) AS tf, ln((1.0::DOUBLE + {total}) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM stats)"""


TFIDF = """weighted AS (SELECT doc_id, idx, (1.0::DOUBLE + ln(dt.tf)) * idf AS x FROM dt JOIN terms USING (term)),
  tfidf AS (SELECT doc_id, idx, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS value FROM weighted)"""

_TERMS = "SELECT term, idx, df, tf, round(idf, 6) AS idf FROM terms"
_VECTORS = "SELECT doc_id, idx, round(value, 6) AS value FROM tfidf"

ORACLE: dict[str, str] = {}

# --- sources and saved tables ---------------------------------------------------------------------

_RAW = f'WITH {REVIEWS} SELECT row_id, game_id, "user", text, rating FROM reviews'
ORACLE["read_reviews_csv"] = _RAW
ORACLE["standardize_columns"] = (
    'SELECT event_id, user_id AS "user", event_type AS game_id, value AS rating, props AS text FROM events'
)
ORACLE["read_reviews_json"] = (
    f"""WITH {REVIEWS} SELECT row_id, 'g' || CAST(floor(row_id / 50) AS BIGINT) AS game_id, text, rating, "user" FROM reviews"""
)
ORACLE["read_reviews_nested"] = (
    f"WITH {REVIEWS} SELECT row_id, 'g' || CAST(row_id // 50 AS VARCHAR) AS game_id, text, rating, \"user\" FROM reviews"
)
ORACLE["game_metadata_join"] = f"""WITH {REVIEWS}, meta AS (
    SELECT game_id, upper(game_id) AS name, min("user") || '|' || max("user") AS categories
    FROM reviews GROUP BY game_id HAVING count(*) % 2 = 0)
  SELECT row_id, game_id, name, coalesce(categories, '') AS categories, CAST(0 AS BIGINT) AS n_mechanics
  FROM reviews LEFT JOIN meta USING (game_id)"""
ORACLE["all_game_ids"] = "SELECT DISTINCT source AS game_id FROM documents"
ORACLE["count_reviews"] = "SELECT count(*) AS n_reviews FROM events WHERE event_type IN ('click', 'view')"
ORACLE["stream_label_reviews"] = f"WITH {REVIEWS}, {KEPT} SELECT row_id, game_id, rating, {BANDS3} AS label FROM kept"
_SPLIT3 = f"WITH {CORPUS}, {split('corpus', '0.2', '0.1')}"
ORACLE["roundtrip_documents"] = (
    f'{_SPLIT3} SELECT doc_id, text AS raw_text, rating, label, game_id, "user", length(text) AS text_length, "set" FROM split'
)
ORACLE["roundtrip_documents_csv"] = f"WITH {CORPUS} SELECT doc_id, text, rating, label FROM corpus"
_FEATURES = f"WITH {CORPUS}, {features_from('corpus')}"
ORACLE["roundtrip_features"] = f"{_FEATURES} SELECT {FEATURE_SELECT} FROM exact"
ORACLE["roundtrip_splits"] = f'{_SPLIT3} SELECT doc_id, "set", label FROM split'
ORACLE["roundtrip_vectors"] = f"WITH {vocabulary(1)}, {TFIDF} {_VECTORS}"
ORACLE["vectorizer_roundtrip"] = f"WITH {vocabulary(1)} {_TERMS}"
ORACLE["sentence_table"] = f"""SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS sentence_idx, unnest(s) AS text
  FROM (SELECT doc_id, {sentences('text')} AS s FROM documents)"""
ORACLE["token_table"] = f"""WITH {token_rows('documents')} SELECT doc_id, CAST(sentence_idx AS BIGINT) AS sentence_idx,
  CAST(token_idx AS BIGINT) AS token_idx, token FROM tok"""
ORACLE["dependency_table"] = f"WITH {annotations('documents')} SELECT * FROM annotations"
_TWO_STEP = f"WITH {CORPUS}, {split('corpus', '0.2', '0.2', True)}"
ORACLE["split_table"] = f'{_TWO_STEP} SELECT doc_id, "set", label FROM split'

_SUBSAMPLE = f"{ranked('corpus')}, balanced AS (SELECT * EXCLUDE (r, n) FROM ranked WHERE r < (SELECT min(n) FROM ranked))"
ORACLE["report_tables"] = f"""WITH {CORPUS}, {_SUBSAMPLE},
  again AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), CAST(doc_id AS VARCHAR)) - 1 AS r,
    count(*) OVER (PARTITION BY label) AS n FROM balanced),
  parts AS (SELECT label, CASE WHEN r < floor(n * 0.2::DOUBLE) THEN 'test'
    WHEN r < floor(n * 0.2::DOUBLE) + floor((n - floor(n * 0.2::DOUBLE)) * 0.2::DOUBLE) THEN 'validation' ELSE 'train' END AS "set" FROM again),
  l AS (SELECT label, count(*) AS c FROM corpus WHERE label IS NOT NULL GROUP BY label),
  b AS (SELECT label, count(*) AS c FROM balanced GROUP BY label),
  p AS (SELECT "set", label, count(*) AS c FROM parts GROUP BY ALL
    UNION ALL SELECT "set", 'all', count(*) FROM parts GROUP BY "set")
  SELECT section, key, round(CAST(value AS DOUBLE), 6) AS value FROM (
    SELECT 'labelled_count' AS section, label AS key, c AS value FROM l
    UNION ALL SELECT 'labelled_percentage', label, c * 100.0::DOUBLE / (SELECT sum(c) FROM l) FROM l
    UNION ALL SELECT 'balanced_count', label, c FROM b
    UNION ALL SELECT 'balanced_percentage', label, c * 100.0::DOUBLE / (SELECT sum(c) FROM b) FROM b
    UNION ALL SELECT 'split_count', "set" || '/' || label, c FROM p
    UNION ALL SELECT 'split_percentage', "set" || '/' || label,
      c * 100.0::DOUBLE / (max(CASE WHEN label = 'all' THEN c END) OVER (PARTITION BY "set")) FROM p)"""

# --- loading and selection --------------------------------------------------------------------------

ORACLE["load_filter"] = f'WITH {REVIEWS}, {KEPT} SELECT row_id, game_id, "user", text, rating FROM kept'
ORACLE["doc_ids"] = f"""WITH {REVIEWS}, {KEPT} SELECT row_id, game_id || '_' ||
  CASE WHEN row_id % 11 <> 0 THEN "user" ELSE 'anonymous' END || '_' || (row_number() OVER (ORDER BY row_id) - 1) AS doc_id FROM kept"""
ORACLE["limit_documents"] = f"WITH {REVIEWS}, {KEPT} SELECT row_id, rating FROM kept ORDER BY row_id LIMIT 100"
ORACLE["metadata_map"] = f"""WITH {REVIEWS} SELECT row_id,
  CAST(json_object('row_id', row_id, 'game_id', game_id, 'user', "user") AS VARCHAR) AS metadata FROM reviews"""
ORACLE["filter_by_game_ids"] = f"WITH {REVIEWS} SELECT row_id, game_id FROM reviews WHERE game_id IN ('src1', 'src2', 'src3')"
ORACLE["filter_by_game_table"] = f"""WITH {REVIEWS} SELECT row_id, game_id FROM reviews
  WHERE game_id IN (SELECT game_id FROM reviews WHERE "user" = 'fr' AND rating > 9.5)"""
ORACLE["docs_by_label"] = f"WITH {CORPUS} SELECT doc_id, rating, label FROM corpus WHERE label = 'negative'"
ORACLE["assign_labels"] = f"WITH {REVIEWS} SELECT row_id, rating, {BANDS3} AS label FROM reviews"
ORACLE["assign_two_labels"] = f"""WITH {RATINGS} SELECT row_id, rating, CASE WHEN rating BETWEEN 7 AND 10 THEN 'positive'
  WHEN rating BETWEEN 1 AND 4 THEN 'negative' END AS label FROM ratings"""
ORACLE["label_by_band_join"] = ORACLE["assign_labels"]
ORACLE["parse_timestamp"] = f"""WITH {RATINGS} SELECT row_id, strftime(try_cast('2024-01-' || lpad(CAST(row_id % 40 AS VARCHAR), 2, '0')
  || 'T10:30:00' AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS timestamp FROM ratings"""
ORACLE["text_preview"] = "SELECT doc_id, substring(text, 1, 300) AS preview, length(text) AS text_length FROM documents"
ORACLE["json_metadata"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

# --- cleaning -----------------------------------------------------------------------------------------


def replaced(expr: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({expr}, {text(pattern)}, {text(by)}, 'g')"


def collapsed(expr: str) -> str:
    return f"trim({replaced(expr, fv.WHITESPACE_CLASS + '+', ' ')}, ' ')"


def without_stopwords(expr: str) -> str:
    listed = one_of(sorted(stopwords()))
    return f"array_to_string(list_filter({tokens(expr)}, lambda t: lower(t) NOT IN {listed}), ' ')"


def cleaned(expr: str, table: str = "documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, {expr} AS text FROM {table}"


def _contracted() -> str:
    out = "text"
    for word, short in [(" the ", " can't "), (" and ", " Won't "), (" of ", "'s "), (" de ", "N'T ")]:
        out = f"replace({out}, {text(word)}, {text(short)})"
    for short, full in fv.WHOLE_WORD_CONTRACTIONS.items():
        for first in (str.upper, str.lower):
            out = replaced(out, rf"\b{first(short[0])}(?i:{short[1:]})\b", first(full[0]) + full[1:])
    for short, full in fv.SUFFIX_CONTRACTIONS.items():
        out = replaced(out, f"(?i){short}", full)
    return out


def _oracle_with_stopwords() -> dict[str, str]:
    """Needs the stopword list, which Spark supplies."""
    basic = collapsed(f"lower({replaced(replaced('text', fv.HTML_TAG), fv.URL)})")
    full = f"""WITH {FORMS}, cleaned AS (SELECT doc_id, {without_stopwords(basic)} AS text FROM documents),
      {annotations('cleaned')}, {_replaced_by_pos}
      SELECT doc_id, coalesce(text, '') AS text FROM documents d LEFT JOIN rejoined USING (doc_id)"""
    return {
        "remove_stopwords": cleaned(without_stopwords("text")),
        "clean_full": full.replace("coalesce(text, '')", "coalesce(rejoined.text, '')"),
        "stopword_anti_join": f"""SELECT term, count(*) AS n FROM (SELECT unnest({tokens('lower(text)')}) AS term FROM documents)
          WHERE term NOT IN {one_of(sorted(stopwords()))} GROUP BY term""",
    }


_replaced_by_pos = """placed AS (SELECT doc_id, sentence_idx, token_idx, token, CASE left(pos, 1) WHEN 'J' THEN 'a'
    WHEN 'V' THEN 'v' WHEN 'N' THEN 'n' WHEN 'R' THEN 'r' ELSE 'n' END AS pos_class FROM annotations),
  rejoined AS (SELECT doc_id, string_agg(coalesce(normal_form, token), ' ' ORDER BY sentence_idx, token_idx) AS text
    FROM placed p LEFT JOIN forms_pos f ON lower(token) = f.term AND p.pos_class = f.pos_class GROUP BY doc_id)"""

ORACLE["clean_remove_html"] = cleaned(replaced("html", fv.HTML_TAG), "pages", "page_id")
ORACLE["clean_remove_urls"] = cleaned(replaced("'see ' || url || '#frag and ' || html", fv.URL), "pages", "page_id")
ORACLE["expand_contractions"] = cleaned(_contracted())
ORACLE["clean_lowercase"] = cleaned("lower(text)")
ORACLE["clean_whitespace"] = cleaned(collapsed("text"))
ORACLE["clean_numbers"] = cleaned(replaced("text", fv.DIGITS, "#"))
ORACLE["clean_punctuation"] = cleaned(
    replaced("text", r"[!-,./:-@\[-`{-~]")
)
ORACLE["separate_punctuation"] = cleaned(replaced("text", r"([!-/:-@\[-`{-~])", r" \1 "))
ORACLE["strip_accents"] = cleaned("strip_accents(text)")
ORACLE["normalize_terms"] = f"""WITH {FORMS}, placed AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
    FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)),
  rejoined AS (SELECT doc_id, string_agg(coalesce(normal_form, token), ' ' ORDER BY pos) AS text
    FROM placed LEFT JOIN forms ON lower(token) = forms.term GROUP BY doc_id)
  SELECT doc_id, coalesce(rejoined.text, '') AS text FROM documents LEFT JOIN rejoined USING (doc_id)"""
ORACLE["normalize_terms_pos"] = f"""WITH {FORMS}, {annotations('documents')}, {_replaced_by_pos}
  SELECT doc_id, coalesce(rejoined.text, '') AS text FROM documents LEFT JOIN rejoined USING (doc_id)"""
ORACLE["clean_basic"] = cleaned(
    collapsed("lower(" + replaced(replaced("url || ' ' || html", fv.HTML_TAG), fv.URL) + ")"), "pages", "page_id"
)

# --- tokens, sentences, n-grams -----------------------------------------------------------------------

ORACLE["tokenize"] = f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
  FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)"""
ORACLE["tokens_by_sentence"] = f"""SELECT doc_id, CAST(sentence_idx AS BIGINT) AS sentence_idx, array_to_string({tokens('s')}, ' ') AS tokens
  FROM (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) - 1 AS sentence_idx
    FROM (SELECT doc_id, {sentences('text')} AS s FROM documents))"""
ORACLE["segment_sentences"] = f"""SELECT doc_id, len(s) AS n_sentences, array_to_string(s, '|') AS sentences
  FROM (SELECT doc_id, {sentences('text')} AS s FROM documents)"""
for _n in (1, 2, 3):
    ORACLE[f"ngrams_{_n}"] = f"""SELECT doc_id, len(g) AS n_terms, array_to_string(g, '|') AS terms
      FROM (SELECT doc_id, {grams('w', _n)} AS g FROM (SELECT doc_id, {words('text')} AS w FROM documents))"""
ORACLE["ngrams_by_lead"] = f"""SELECT term, count(*) AS n FROM (SELECT unnest({grams('w', 3)}) AS term
  FROM (SELECT {words('text')} AS w FROM documents)) GROUP BY term"""
ORACLE["token_pos_join"] = f"""WITH {annotations('documents')}
  SELECT doc_id, sentence_idx, token_idx, token, pos AS pos_tag FROM annotations"""
ORACLE["fill_heads"] = ORACLE["dependency_table"]
ORACLE["annotate_by_rules"] = ORACLE["dependency_table"]


def _unit(letter: str) -> str:
    return rf"{letter}\x{{1}}[^\x{{2}}]*\x{{2}}"


_NP = f"(?:{_unit('D')})?(?:{_unit('J')})*(?:{_unit('N')})+"
ORACLE["noun_phrases"] = f"""WITH {annotations('documents')}, spelled AS (SELECT doc_id, sentence_idx, string_agg(
    CASE pos WHEN 'DT' THEN 'D' WHEN 'JJ' THEN 'J' WHEN 'NN' THEN 'N' ELSE 'O' END || chr(1) || token || chr(2), ''
    ORDER BY token_idx) AS s FROM annotations GROUP BY ALL),
  found AS (SELECT doc_id, sentence_idx, regexp_extract_all(s, {text(_NP)}) AS f FROM spelled)
  SELECT doc_id, sentence_idx, CAST(generate_subscripts(f, 1) - 1 AS BIGINT) AS phrase_idx,
    rtrim({replaced(replaced('unnest(f)', '[DJN]' + chr(92) + 'x{1}'), chr(92) + 'x{2}', ' ')}, ' ') AS phrase FROM found"""

# --- features -----------------------------------------------------------------------------------------------

ORACLE["linguistic_features"] = ORACLE["roundtrip_features"]
ORACLE["linguistic_features_annotated"] = ORACLE["roundtrip_features"]
ORACLE["lexicon_split"] = f"""WITH {DERIVED_LEXICON} SELECT term, valence,
  CASE WHEN valence > 0 THEN 'positive' ELSE 'negative' END AS polarity FROM derived WHERE valence <> 0"""
_DOCS = "docs AS (SELECT doc_id, text, NULL AS label, NULL::DOUBLE AS rating FROM documents)"
_DOC_FEATURES = f"WITH {_DOCS}, {features_from('docs')}"


def _from_features(*columns: str, where: str = "") -> str:
    shown = ", ".join(f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in columns)
    return f"{_DOC_FEATURES} SELECT doc_id, {shown} FROM exact {where}"


ORACLE["opinion_words"] = _from_features("positive_word_count", "negative_word_count", "opinion_word_ratio")
ORACLE["opinion_words_large_lexicon"] = f"""WITH {DERIVED_LEXICON}, placed AS (
    SELECT doc_id, unnest({tokens('lower(text)')}) AS term FROM documents),
  c AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE valence > 0) AS p, count(*) FILTER (WHERE valence < 0) AS q
    FROM placed LEFT JOIN derived USING (term) GROUP BY doc_id)
  SELECT doc_id, coalesce(p, 0) AS positive_word_count, coalesce(q, 0) AS negative_word_count,
    round({ratio('coalesce(p, 0) - coalesce(q, 0)', 'coalesce(n, 0)')}, 6) AS opinion_word_ratio
  FROM documents LEFT JOIN c USING (doc_id)"""
# documents without tokens have no annotations and so no row
ORACLE["negations"] = _from_features("negation_count", "has_negation", "negated_opinion_words", where="WHERE token_count > 0")
ORACLE["intensifiers"] = _from_features(
    "intensifier_count", "mitigator_count", "has_intensifier", "has_mitigator", where="WHERE token_count > 0"
)
ORACLE["domain_vocabulary"] = _from_features(
    "domain_word_count", "domain_word_ratio", "has_domain_words", "domain_opinion_overlap"
)
ORACLE["domain_word_freq"] = f"""SELECT term, count(*) AS n FROM (SELECT unnest({tokens('lower(text)')}) AS term FROM documents)
  WHERE term IN {one_of(fx.DOMAIN)} GROUP BY term"""
ORACLE["structural_features"] = f"""{_FEATURES} SELECT doc_id, text_length, sentence_count, token_count,
  round(avg_sentence_length, 6) AS avg_sentence_length, round(rating, 6) AS rating FROM exact"""
ORACLE["valence_scores"] = _from_features("vader_compound", "vader_positive", "vader_negative", "vader_neutral")
ORACLE["lexicon_semi_join"] = f"""WITH {DERIVED_LEXICON} SELECT DISTINCT doc_id FROM (
    SELECT doc_id, unnest({tokens('lower(text)')}) AS term FROM documents)
  WHERE term IN (SELECT term FROM derived WHERE valence > 0 AND length(term) > 12)"""

# --- statistics ------------------------------------------------------------------------------------------------

ORACLE["corpus_counts"] = f"WITH {CORPUS} SELECT count(*) AS total_documents, count(label) AS labeled_documents FROM corpus"
ORACLE["label_distribution"] = f"""WITH {CORPUS} SELECT label, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percentage FROM corpus WHERE label IS NOT NULL GROUP BY label"""
ORACLE["rating_distribution"] = f"WITH {RATINGS} SELECT rating, count(*) AS n FROM ratings GROUP BY rating"
ORACLE["text_length_stats"] = f"""WITH {CORPUS}, t AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM corpus)
  SELECT round(avg(x), 4) AS mean, round(median(x), 4) AS median, min(x) AS min, max(x) AS max, round(stddev_pop(x), 4) AS std FROM t"""
ORACLE["avg_rating_per_label"] = f"""WITH {RATINGS}, x AS (SELECT *, {BANDS3} AS label FROM ratings)
  SELECT label, round(avg(rating), 6) AS avg_rating FROM x WHERE label IS NOT NULL GROUP BY label"""
ORACLE["reviews_per_game"] = f"""WITH {RATINGS}, g AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ratings GROUP BY game_id)
  SELECT count(*) AS unique_games, round(avg(n), 6) AS mean, round(median(n), 6) AS median, min(n) AS min, max(n) AS max FROM g"""
ORACLE["corpus_statistics"] = f"""WITH {CORPUS}, t AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM corpus),
  g AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM corpus GROUP BY game_id),
  s AS (SELECT 'documents' AS metric, 'total_documents' AS key, CAST(count(*) AS DOUBLE) AS value FROM corpus
    UNION ALL SELECT 'documents', 'labeled_documents', count(label) FROM corpus
    UNION ALL SELECT 'label_distribution', label, count(*) FROM corpus WHERE label IS NOT NULL GROUP BY label
    UNION ALL SELECT 'avg_rating_per_label', label, avg(rating) FROM corpus WHERE label IS NOT NULL GROUP BY label
    UNION ALL SELECT 'rating_distribution', CAST(rating AS VARCHAR), count(*) FROM corpus GROUP BY rating
    UNION ALL SELECT 'text_length', unnest(['mean', 'median', 'min', 'max', 'std']),
      unnest([avg(x), median(x), min(x), max(x), stddev_pop(x)]) FROM t
    UNION ALL SELECT 'reviews_per_game', unnest(['unique_games', 'mean', 'median', 'min', 'max']),
      unnest([CAST(count(*) AS DOUBLE), avg(n), median(n), min(n), max(n)]) FROM g)
  SELECT metric, key, round(value, 4) AS value FROM s"""
ORACLE["feature_averages"] = f"""{_FEATURES} SELECT round(avg(positive_word_count), 6) AS avg_positive_word_count,
  round(avg(negative_word_count), 6) AS avg_negative_word_count, round(avg(negation_count), 6) AS avg_negation_count,
  round(avg(intensifier_count), 6) AS avg_intensifier_count, round(avg(domain_word_count), 6) AS avg_domain_word_count,
  round(avg(vader_compound), 6) AS avg_vader_compound FROM exact"""
ORACLE["feature_averages_by_label"] = f"""{_FEATURES} SELECT label, count(*) AS n,
  round(avg(positive_word_count), 6) AS avg_positive_word_count, round(avg(negative_word_count), 6) AS avg_negative_word_count,
  round(avg(vader_compound), 6) AS avg_vader_compound, round(avg(negation_count), 6) AS avg_negation_count
  FROM exact WHERE label IS NOT NULL GROUP BY label"""
ORACLE["feature_ratios"] = f"""{_FEATURES} SELECT doc_id, round({ratio('negation_count', 'token_count')}, 6) AS negation_ratio,
  round({ratio('intensifier_count', 'token_count')}, 6) AS intensifier_ratio FROM exact"""
ORACLE["split_distribution"] = f"""{_TWO_STEP}, c AS (SELECT "set", label, count(*) AS n FROM split GROUP BY ALL
    UNION ALL SELECT "set", 'all', count(*) FROM split GROUP BY "set")
  SELECT "set", label, n, round(n * 100.0::DOUBLE / max(CASE WHEN label = 'all' THEN n END) OVER (PARTITION BY "set"), 6) AS percentage FROM c"""

# --- balancing and splitting -------------------------------------------------------------------------------------

ORACLE["balance_subsample"] = f"WITH {CORPUS}, {_SUBSAMPLE} SELECT doc_id, label, rating FROM balanced"
_OVERSAMPLED = f"""{ranked('corpus')}, sizes AS (SELECT DISTINCT label, n FROM ranked),
  draws AS (SELECT label, n, unnest(range((SELECT max(n) FROM sizes))) AS draw FROM sizes),
  drawn AS (SELECT label, draw, CASE WHEN n = (SELECT max(n) FROM sizes) THEN draw
    ELSE CAST('0x' || substr(md5('42:' || label || ':' || draw), 1, 15) AS BIGINT) % n END AS r FROM draws),
  oversampled AS (SELECT doc_id, ranked.label AS label, draw FROM drawn JOIN ranked ON drawn.label = ranked.label AND drawn.r = ranked.r)"""
ORACLE["balance_oversample"] = f"WITH {CORPUS}, {_OVERSAMPLED} SELECT doc_id, label, draw FROM oversampled"
_SPLIT2 = f"WITH {CORPUS}, {split('corpus', '0.2', '0.0')}"
ORACLE["stratified_split"] = f'{_SPLIT2} SELECT doc_id, label, "set" FROM split'
ORACLE["stratified_split_3way"] = f'{_SPLIT3} SELECT doc_id, label, "set" FROM split'
ORACLE["split_two_step"] = f'{_TWO_STEP} SELECT doc_id, label, "set" FROM split'


def folded(source: str) -> str:
    sizes = "+".join(f"CAST(r >= {i} * (n // 5) + least(n % 5, {i}) AS BIGINT)" for i in range(1, 5))
    return f"{ranked(source)}, folded AS (SELECT doc_id, label, {sizes} AS fold FROM ranked)"


ORACLE["stratified_folds"] = f"WITH {CORPUS}, {folded('corpus')} SELECT doc_id, label, fold FROM folded"
ORACLE["union_splits"] = ORACLE["stratified_split"]
ORACLE["split_disjoint"] = f"""{_SPLIT3}, p AS (SELECT * FROM (VALUES ('test', 'validation'), ('test', 'train'), ('train', 'validation')) v(a, b))
  SELECT a || '/' || b AS parts, (SELECT count(*) FROM split x JOIN split y USING (doc_id) WHERE x."set" = a AND y."set" = b) AS shared,
    (SELECT count(*) FROM split WHERE "set" IN (a, b)) AS both_parts FROM p"""

# --- vectors -----------------------------------------------------------------------------------------------------

ORACLE["tfidf_vocabulary"] = f"WITH {vocabulary(2)} {_TERMS}"
ORACLE["tfidf_vocabulary_prefiltered"] = f"WITH {vocabulary(3)} {_TERMS}"
ORACLE["tfidf_vocabulary_unlimited"] = f"""WITH {vocabulary(1, None, min_df='3',
    max_df='0.5::DOUBLE * (SELECT count(*) FROM documents)')} {_TERMS}"""
for _n in (1, 2, 3):
    ORACLE[f"tfidf_transform_{_n}gram"] = f"WITH {vocabulary(_n)}, {TFIDF} {_VECTORS}"
ORACLE["count_vectorize"] = f"WITH {vocabulary(1)} SELECT doc_id, idx, CAST(dt.tf AS DOUBLE) AS value FROM dt JOIN terms USING (term)"


def matrix(columns: list[str]) -> str:
    names = ", ".join(text(c) for c in columns)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in columns)
    return f"""cells AS (SELECT doc_id, unnest(range({len(columns)})) AS idx, unnest([{values}]) AS value,
      unnest([{names}]) AS name FROM exact)"""


ORACLE["linguistic_matrix"] = (
    f"{_FEATURES}, {matrix(fv.FEATURE_COLUMNS)} SELECT doc_id, idx, round(value, 6) AS value FROM cells"
)
_NO_RATING = [c for c in fv.FEATURE_COLUMNS if c != "rating"]
ORACLE["combine_features"] = f"""{_FEATURES}, {matrix(_NO_RATING)}, {vocabulary(1)}, {TFIDF}
  SELECT doc_id, idx, round(value, 6) AS value FROM tfidf UNION ALL
  SELECT doc_id, idx + (SELECT count(*) FROM terms), round(value, 6) FROM cells"""
ORACLE["feature_names"] = f"WITH {vocabulary(2)} SELECT idx, term FROM terms"
ORACLE["top_terms_per_doc"] = f"""WITH {vocabulary(1)}, {TFIDF}, named AS (
    SELECT doc_id, term, round(value, 9) AS value FROM tfidf JOIN terms USING (idx)),
  placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY value DESC, term) AS rank FROM named)
  SELECT doc_id, rank, term, value FROM placed WHERE rank <= 10"""
ORACLE["vocabulary_by_order"] = f"""WITH {vocabulary(3)}, placed AS (SELECT idx, term, row_number() OVER (
    PARTITION BY len(string_split(term, ' ')) ORDER BY idx) AS p FROM terms) SELECT idx, term FROM placed WHERE p <= 10"""
ORACLE["matrix_sparsity"] = f"""WITH {vocabulary(1)}, {TFIDF} SELECT count(*) AS nnz,
  round((1.0::DOUBLE - count(*) / ((SELECT count(*) FROM documents) * {fv.NGRAM_FEATURES[1]}.0::DOUBLE)) * 100.0::DOUBLE, 6) AS sparsity FROM tfidf"""

# --- naive Bayes, scaling, cross-validation -------------------------------------------------------------------------

_QUALITY = """quality AS (SELECT doc_id, text, CAST(quality AS VARCHAR) AS label,
    CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS "set" FROM documents JOIN labels USING (doc_id))"""
_QUALITY_TERMS = f"{_QUALITY}, {vocabulary(1, fv.NGRAM_FEATURES[1], 'quality', '1', '(SELECT count(*) FROM quality)')}"
_BAYES = f"""{_QUALITY_TERMS}, vec AS (SELECT doc_id, idx, CAST(dt.tf AS DOUBLE) AS value FROM dt JOIN terms USING (term)),
  counts AS (SELECT idx, 0.5::DOUBLE + coalesce(sum(value) FILTER (WHERE label = '0'), 0) AS c0,
      0.5::DOUBLE + coalesce(sum(value) FILTER (WHERE label = '1'), 0) AS c1
    FROM terms LEFT JOIN (SELECT idx, label, value FROM vec JOIN quality USING (doc_id) WHERE "set" = 'train') USING (idx) GROUP BY idx),
  model AS (SELECT idx, ln(c0) - ln((SELECT sum(c0) FROM counts)) AS p0, ln(c1) - ln((SELECT sum(c1) FROM counts)) AS p1 FROM counts)"""
ORACLE["naive_bayes_fit"] = f"WITH {_BAYES} SELECT idx, round(p0, 6) AS log_p_0, round(p1, 6) AS log_p_1 FROM model"
ORACLE["naive_bayes_predict"] = f"""WITH {_BAYES}, prior AS (SELECT ln(avg(CAST(label = '0' AS DOUBLE))) AS l0,
    ln(avg(CAST(label = '1' AS DOUBLE))) AS l1 FROM quality WHERE "set" = 'train'),
  sums AS (SELECT doc_id, sum(value * p0) AS s0, sum(value * p1) AS s1 FROM vec JOIN model USING (idx) GROUP BY doc_id),
  scored AS (SELECT doc_id, "set", label, coalesce(s0, 0) + (SELECT l0 FROM prior) AS s0,
    coalesce(s1, 0) + (SELECT l1 FROM prior) AS s1 FROM quality LEFT JOIN sums USING (doc_id))
  SELECT doc_id, "set", label, round(s0, 5) AS score_0, round(s1, 5) AS score_1,
    CASE WHEN s0 >= s1 THEN '0' ELSE '1' END AS prediction FROM scored"""
ORACLE["minmax_scale"] = f"""{_FEATURES}, {matrix(fv.FEATURE_COLUMNS)},
  limits AS (SELECT idx, min(value) AS low, max(value) AS high FROM cells GROUP BY idx)
  SELECT doc_id, idx, round(CASE WHEN high = low THEN value - low ELSE (value - low) / (high - low) END, 6) AS value
  FROM cells JOIN limits USING (idx)"""
ORACLE["cross_validate_naive_bayes"] = f"""WITH {_QUALITY_TERMS}, {folded('quality')},
  vec AS (SELECT doc_id, idx, CAST(dt.tf AS DOUBLE) AS value, label, fold FROM dt JOIN terms USING (term) JOIN folded USING (doc_id)),
  fold_ids AS (SELECT unnest(range(5)) AS f), alphas AS (SELECT unnest([0.01, 0.1, 0.5, 1.0, 2.0])::DOUBLE AS alpha),
  counts AS (SELECT f, idx, coalesce(sum(value) FILTER (WHERE label = '0' AND fold <> f), 0) AS c0,
      coalesce(sum(value) FILTER (WHERE label = '1' AND fold <> f), 0) AS c1 FROM vec, fold_ids GROUP BY f, idx),
  model AS (SELECT f, idx, alpha, ln(c0 + alpha) - ln(sum(c0 + alpha) OVER (PARTITION BY f, alpha)) AS p0,
      ln(c1 + alpha) - ln(sum(c1 + alpha) OVER (PARTITION BY f, alpha)) AS p1 FROM counts, alphas),
  sums AS (SELECT doc_id, alpha, sum(value * p0) AS s0, sum(value * p1) AS s1
    FROM vec JOIN model ON vec.fold = model.f AND vec.idx = model.idx GROUP BY ALL),
  prior AS (SELECT f, avg(CAST(label = '0' AS DOUBLE)) AS a0, avg(CAST(label = '1' AS DOUBLE)) AS a1
    FROM folded, fold_ids WHERE fold <> f GROUP BY f),
  scored AS (SELECT d.doc_id, d.label, d.fold, a.alpha, fp.fit_prior,
      coalesce(s0, 0) + CASE WHEN fp.fit_prior THEN ln(a0) ELSE ln(0.5::DOUBLE) END AS s0,
      coalesce(s1, 0) + CASE WHEN fp.fit_prior THEN ln(a1) ELSE ln(0.5::DOUBLE) END AS s1
    FROM folded d CROSS JOIN alphas a CROSS JOIN (VALUES (true), (false)) fp(fit_prior)
      LEFT JOIN sums ON sums.doc_id = d.doc_id AND sums.alpha = a.alpha JOIN prior ON prior.f = d.fold)
  SELECT alpha, fit_prior, fold, count(*) AS n,
    count(*) FILTER (WHERE label = CASE WHEN s0 >= s1 THEN '0' ELSE '1' END) AS hits FROM scored GROUP BY ALL"""

# --- evaluation ---------------------------------------------------------------------------------------------------------

ORACLE["confusion_matrix"] = f"""WITH {PREDICTIONS} SELECT CASE label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END::BIGINT AS position,
  label, count(*) FILTER (WHERE prediction = 'negative') AS negative, count(*) FILTER (WHERE prediction = 'neutral') AS neutral,
  count(*) FILTER (WHERE prediction = 'positive') AS positive FROM predictions GROUP BY label"""


def per_class(by: str, source: str = "predictions") -> str:
    """View m: precision, recall, F1, support per class (and `by`)."""
    b, using = (f"{by}, ", f"({by}, label)") if by else ("", "(label)")
    return f"""act AS (SELECT {b}label, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS hits FROM {source} GROUP BY ALL),
  pre AS (SELECT {b}prediction AS label, count(*) AS predicted FROM {source} GROUP BY ALL),
  m AS (SELECT {b}label, CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0::DOUBLE ELSE hits / CAST(predicted AS DOUBLE) END AS precision,
    hits / CAST(support AS DOUBLE) AS recall, 2.0::DOUBLE * hits / (coalesce(predicted, 0) + support) AS f1, support
    FROM act LEFT JOIN pre USING {using})"""


_WEIGHTED = """sum(recall * support) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
  sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1_score"""
_W6 = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score"
ORACLE["weighted_metrics"] = f"WITH {PREDICTIONS}, {per_class('')} SELECT {_W6} FROM (SELECT {_WEIGHTED} FROM m)"
ORACLE["per_class_metrics"] = f"""WITH {PREDICTIONS}, {per_class('')}
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM m"""
ORACLE["classification_report"] = f"""WITH {PREDICTIONS}, {per_class('')}, r AS (SELECT label, precision, recall, f1, support FROM m
    UNION ALL SELECT 'accuracy', NULL, NULL, sum(recall * support) / sum(support), sum(support) FROM m
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) FROM m)
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r"""
ORACLE["metrics_by_set"] = f"""WITH {PREDICTIONS}, {per_class('"set"')}
  SELECT "set", {_W6} FROM (SELECT "set", {_WEIGHTED} FROM m GROUP BY "set")"""
ORACLE["macro_f1"] = f"WITH {PREDICTIONS}, {per_class('')} SELECT round(avg(f1), 6) AS f1_macro FROM m"
ORACLE["model_ranking"] = f"""WITH {PREDICTIONS}, judged AS (
    SELECT 'given' AS model, "set" AS representation, label, prediction FROM predictions
    UNION ALL SELECT 'constant', "set", label, 'neutral' FROM predictions
    UNION ALL SELECT 'mixed', "set", label, CASE WHEN doc_id % 4 = 0 THEN 'positive' ELSE label END FROM predictions),
  {per_class('model, representation', 'judged')},
  results AS (SELECT model, representation, {_WEIGHTED} FROM m GROUP BY ALL)
  SELECT model, representation, {_W6}, row_number() OVER (ORDER BY round(f1_score, 9) DESC, model, representation) AS rank FROM results"""

ORACLE["limit_documents_many"] = f"""WITH {RATINGS}, keyed AS (SELECT CASE WHEN row_id % 50 = 0 THEN NULL ELSE row_id * 7919 % 1000003 END AS key, row_id FROM ratings)
  SELECT CAST(coalesce(key, -1) AS BIGINT) AS key, row_id FROM (SELECT * FROM keyed ORDER BY key NULLS FIRST LIMIT 1500)"""

ORACLE["stream_statistics"] = f"""WITH {CORPUS}, t AS (SELECT 'label' AS level, coalesce(label, '') AS label, rating, length(text) AS x FROM corpus
    UNION ALL SELECT 'all', 'all', rating, length(text) FROM corpus)
  SELECT level, label, count(*) AS n, round(avg(rating), 6) AS avg_rating, round(avg(x), 6) AS mean_length, round(stddev_pop(x), 6) AS std_length,
    CAST(min(x) AS BIGINT) AS min_length, CAST(max(x) AS BIGINT) AS max_length FROM t GROUP BY ALL"""

# --- stems, one step of the cascade after the other ------------------------------------------------------------

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_SOME, _ONE, _MORE = f"^({_C})?{_V}{_C}", f"^({_C})?{_V}{_C}({_V})?$", f"^({_C})?{_V}{_C}{_V}{_C}"


def _cut(word: str, n: int) -> str:
    return f"left({word}, length({word}) - {n})"


def _fits(word: str, pattern: str) -> str:
    return f"regexp_matches({word}, {text(pattern)})"


def _rules(rules: list[tuple[str, str]], pattern: str | None) -> str:
    def changed(suffix: str, ending: str) -> str:
        new = f"{_cut('w', len(suffix))} || '{ending}'"
        return new if pattern is None else f"CASE WHEN {_fits(_cut('w', len(suffix)), pattern)} THEN {new} ELSE w END"

    return "CASE " + " ".join(f"WHEN ends_with(w, '{s}') THEN {changed(s, e)}" for s, e in rules) + " ELSE w END"


def _short(word: str) -> str:
    pattern = "(^[aeiou][^aeiou]$)|(([aeiou]y|[^aeiouy])[aeiouy][^aeiouwxy]$)"
    return f"({_fits(word, pattern)} AND NOT {_fits(word, '[aeiou]y[^aeiouwxy]$')})"


def _past(n: int) -> str:
    s = _cut("w", n)
    return f"""CASE WHEN NOT {_fits(s, f'^({_C})?[aeiouy]')} THEN w WHEN {_fits(s, '(at|bl|iz)$')} THEN {s} || 'e'
      WHEN {_fits(s, '(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$')} THEN {_cut('w', n + 1)}
      WHEN {_fits(s, _ONE)} AND {_short(s)} THEN {s} || 'e' ELSE {s} END"""


_STEM_STEPS = [
    f"CASE WHEN ends_with(w, 'ies') AND length(w) = 4 THEN {_cut('w', 1)} ELSE {_rules(stems.PLURALS, None)} END",
    f"""CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {_cut('w', 1)} ELSE {_cut('w', 2)} END
      WHEN ends_with(w, 'eed') THEN CASE WHEN {_fits(_cut('w', 3), _SOME)} THEN {_cut('w', 1)} ELSE w END
      WHEN ends_with(w, 'ed') THEN {_past(2)} WHEN ends_with(w, 'ing') THEN {_past(3)} ELSE w END""",
    f"CASE WHEN {_fits('w', '[^aeiou]y$')} AND NOT {_fits('w', '([aeiou]|^)yy$')} AND length(w) > 2 THEN {_cut('w', 1)} || 'i' ELSE w END",
    f"CASE WHEN ends_with(w, 'alli') AND {_fits(_cut('w', 4), _SOME)} THEN {_cut('w', 2)} ELSE w END",
    f"""CASE WHEN ends_with(w, 'logi') THEN CASE WHEN {_fits(_cut('w', 3), _SOME)} THEN {_cut('w', 1)} ELSE w END
      ELSE {_rules(stems.DOUBLE_SUFFIXES, _SOME)} END""",
    _rules(stems.SHORT_SUFFIXES, _SOME),
    f"""CASE WHEN ends_with(w, 'ion') THEN CASE WHEN {_fits(_cut('w', 3), _MORE)} AND {_fits(_cut('w', 3), '[st]$')} THEN {_cut('w', 3)} ELSE w END
      ELSE {_rules([(e, '') for e in stems.ENDINGS if e != 'ion'], _MORE)} END""",
    f"""CASE WHEN ends_with(w, 'e') AND ({_fits(_cut('w', 1), _MORE)} OR ({_fits(_cut('w', 1), _ONE)} AND NOT {_short(_cut('w', 1))}))
      THEN {_cut('w', 1)} ELSE w END""",
    f"CASE WHEN ends_with(w, 'll') AND {_fits(_cut('w', 1), _MORE)} THEN {_cut('w', 1)} ELSE w END",
]
_IRREGULAR = "CASE term " + " ".join(f"WHEN '{w}' THEN '{f}'" for w, f in stems.IRREGULAR.items()) + " END"
_STEMMED = f"""words AS (SELECT DISTINCT lower(unnest({tokens('text')})) AS term FROM documents),
  s0 AS (SELECT term, regexp_replace(term, '^y', 'Y') AS w FROM words),
  {", ".join(f"s{i} AS (SELECT term, {step} AS w FROM s{i - 1})" for i, step in enumerate(_STEM_STEPS, 1))},
  stemmed AS (SELECT term, coalesce({_IRREGULAR}, CASE WHEN length(term) <= 2 THEN term ELSE regexp_replace(w, '^Y', 'y') END) AS normal_form
    FROM s{len(_STEM_STEPS)})"""
ORACLE["stem_vocabulary"] = f"WITH {_STEMMED} SELECT term, normal_form FROM stemmed WHERE term <> normal_form"
ORACLE["stem_texts"] = f"""WITH {_STEMMED}, placed AS (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
    FROM (SELECT doc_id, {tokens('lower(text)')} AS t FROM documents)),
  rejoined AS (SELECT doc_id, string_agg(normal_form, ' ' ORDER BY pos) AS text FROM placed JOIN stemmed ON token = term GROUP BY doc_id)
  SELECT doc_id, coalesce(rejoined.text, '') AS text FROM documents LEFT JOIN rejoined USING (doc_id)"""

# --- lemmas: rules applied again and again until a form is in the lexicon -----------------------------------------

_RULE_ROWS = ", ".join(
    f"('{pos}', {n}, '{cut}', '{put}')" for pos in "nv" for n, (cut, put) in enumerate(normalization.LEMMA_RULES[pos])
)
ORACLE["lemma_vocabulary"] = f"""WITH RECURSIVE words AS (SELECT term, pos_class FROM (SELECT DISTINCT lower(unnest({tokens('text')})) AS term FROM documents),
    (VALUES ('n'), ('v')) p(pos_class)),
  rule(pos_class, n, cut, put) AS (VALUES {_RULE_ROWS}),
  special AS (SELECT term, pos_class, left(term, 2) AS form FROM words WHERE term LIKE 'th%' AND pos_class = 'v'),
  gen(term, pos_class, depth, path, form) AS (
    SELECT w.term, pos_class, 1, [n], left(w.term, length(w.term) - length(cut)) || put FROM words w JOIN rule USING (pos_class)
      WHERE ends_with(w.term, cut) AND NOT EXISTS (SELECT 1 FROM special s WHERE s.term = w.term AND s.pos_class = w.pos_class)
    UNION ALL
    SELECT term, pos_class, depth + 1, list_append(path, n), left(form, length(form) - length(cut)) || put FROM gen JOIN rule USING (pos_class)
      WHERE ends_with(form, cut)),
  tried AS (SELECT term, pos_class, 1 AS depth, [-1] AS path, term AS form FROM words
    UNION ALL SELECT term, pos_class, 1, [0], form FROM special UNION ALL SELECT * FROM gen),
  known AS (SELECT * FROM tried WHERE length(form) % 2 = 0 AND (form, pos_class) IN (SELECT (term, pos_class) FROM words)),
  best AS (SELECT *, row_number() OVER (PARTITION BY term, pos_class ORDER BY depth, length(form), path) AS place FROM known)
  SELECT term, pos_class, form AS normal_form FROM best WHERE place = 1"""

# --- valence by word order: the words behind each word as columns, one effect after the other ----------------------

_MARK = r"(?:[.!?,;:\-'\"]|!!!?|\?\?\??|\?!\?!?|!\?!\??)"
_BARE = r"([^!-/:-@\[-`{-~\s]{2,})"
_WORDS = f"list_filter(regexp_split_to_array(t, {text(fv.WHITESPACE_CLASS + '+')}), lambda x: length(x) > 1)"


def _among(expr: str, words: list[str]) -> str:
    return f"coalesce({expr} IN ({', '.join(text(w) for w in words)}), false)"


def _effect(back: int) -> str:
    """Column v after the word `back` places before has had its effect."""
    low, strong, weak = f"l{back}", _among(f"l{back}", fv.BOOSTERS), _among(f"l{back}", fv.DAMPENERS)
    step = f"(CASE WHEN {strong} THEN 0.293::DOUBLE WHEN {weak} THEN -0.293::DOUBLE ELSE 0.0::DOUBLE END * CASE WHEN v < 0 THEN -1 ELSE 1 END)"
    shout = f"(CASE WHEN ({strong} OR {weak}) AND c{back} AND mixed THEN CASE WHEN v > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0.0::DOUBLE END)"
    so = {b: _among(f"w{b}", ["so", "this"]) for b in (1, 2)}
    emphatic = {1: "false", 2: f"w2 = 'never' AND {so[1]}", 3: f"(w3 = 'never' AND {so[2]}) OR {so[1]}"}[back]
    negated = f"({_among(low, fv.VALENCE_NEGATIONS)} OR contains({low}, 'n''t'))"
    factor = f"CASE WHEN coalesce({emphatic}, false) THEN {fv.NEVER_FACTORS[back - 1]}::DOUBLE WHEN {negated} THEN -0.74::DOUBLE ELSE 1.0::DOUBLE END"
    out = f"(v + ({step} + {shout}) * {fv.BOOSTER_DECAY[back - 1]}::DOUBLE) * {factor}"
    if back == 3:
        idiom = "CASE {} " + " ".join(f"WHEN {text(p)} THEN {x}::DOUBLE" for p, x in fv.VALENCE_IDIOMS.items()) + " END"
        spans = ["w || ' ' || n1 || ' ' || n2", "w || ' ' || n1", "w1 || ' ' || w", "w2 || ' ' || w1 || ' ' || w", "w2 || ' ' || w1",
                 "w3 || ' ' || w2 || ' ' || w1", "w3 || ' ' || w2"]
        held = ", ".join(idiom.format(s) for s in spans)
        pair = f"{_among(spans[6], fv.DAMPENER_PAIRS)} OR {_among(spans[4], fv.DAMPENER_PAIRS)}"
        out = f"coalesce({held}, {out}) - CASE WHEN {pair} THEN 0.293::DOUBLE ELSE 0.0::DOUBLE END"
    return f"CASE WHEN v IS NOT NULL AND i > {back} AND x{back} IS NULL THEN {out} ELSE v END"


_BEHIND = ", ".join(f"lag(w, {b}) OVER d AS w{b}, lag(low, {b}) OVER d AS l{b}, lag(caps, {b}) OVER d AS c{b}, lag(value, {b}) OVER d AS x{b}" for b in (1, 2, 3))
ORACLE["rule_valence_scores"] = f"""WITH {LEXICON}, body AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  split AS (SELECT doc_id, unnest(ws) AS piece, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, {_WORDS} AS ws FROM body)),
  bare AS (SELECT doc_id, i, regexp_replace(regexp_replace(piece, {text('^' + _MARK + _BARE + '$')}, '\\1'), {text('^' + _BARE + _MARK + '$')}, '\\1') AS w FROM split),
  lowered AS (SELECT *, lower(w) AS low, (w = upper(w) AND w <> lower(w)) AS caps FROM bare),
  valued AS (SELECT lowered.*, valence AS value FROM lowered LEFT JOIN lexicon ON low = term),
  placed AS (SELECT *, {_BEHIND}, lead(w, 1) OVER d AS n1, lead(w, 2) OVER d AS n2, lead(low, 1) OVER d AS nl1,
      count(*) FILTER (WHERE caps) OVER a BETWEEN 1 AND count(*) OVER a - 1 AS mixed, min(CASE WHEN low = 'but' THEN i END) OVER a AS but
    FROM valued WINDOW d AS (PARTITION BY doc_id ORDER BY i), a AS (PARTITION BY doc_id)),
  e0 AS (SELECT *, value + CASE WHEN caps AND mixed THEN CASE WHEN value > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0.0::DOUBLE END AS v FROM placed),
  e1 AS (SELECT * REPLACE ({_effect(1)} AS v) FROM e0), e2 AS (SELECT * REPLACE ({_effect(2)} AS v) FROM e1), e3 AS (SELECT * REPLACE ({_effect(3)} AS v) FROM e2),
  e4 AS (SELECT doc_id, i, but, CASE WHEN v IS NULL OR {_among('low', fv.BOOSTERS + fv.DAMPENERS)} OR (low = 'kind' AND coalesce(nl1 = 'of', false)) THEN 0.0::DOUBLE
      WHEN i > 1 AND l1 = 'least' AND x1 IS NULL AND NOT (i > 2 AND {_among('l2', ['at', 'very'])}) THEN v * -0.74::DOUBLE ELSE v END AS v FROM e3),
  e5 AS (SELECT doc_id, i, CASE WHEN i < but THEN v * 0.5::DOUBLE WHEN i > but THEN v * 1.5::DOUBLE ELSE v END AS v FROM e4),
  sums AS (SELECT doc_id, sum(v ORDER BY i) AS total, coalesce(sum(v + 1 ORDER BY i) FILTER (WHERE v > 0), 0.0::DOUBLE) AS up,
      coalesce(sum(1 - v ORDER BY i) FILTER (WHERE v < 0), 0.0::DOUBLE) AS down, count(*) FILTER (WHERE v = 0) AS flat FROM e5 GROUP BY doc_id),
  loud AS (SELECT doc_id, least(length(t) - length(replace(t, '!', '')), 4) * 0.292::DOUBLE
      + CASE WHEN q > 3 THEN 0.96::DOUBLE WHEN q > 1 THEN q * 0.18::DOUBLE ELSE 0.0::DOUBLE END AS loud
    FROM (SELECT *, length(t) - length(replace(t, '?', '')) AS q FROM body)),
  shares AS (SELECT doc_id, coalesce(total + sign(total) * loud, 0.0::DOUBLE) AS total, coalesce(up + CASE WHEN up > down THEN loud ELSE 0.0::DOUBLE END, 0.0::DOUBLE) AS up,
      coalesce(down + CASE WHEN up < down THEN loud ELSE 0.0::DOUBLE END, 0.0::DOUBLE) AS down, coalesce(flat, 0) AS flat FROM loud LEFT JOIN sums USING (doc_id))
  SELECT doc_id, round(total / sqrt(total * total + 15.0::DOUBLE), 4) AS vader_compound,
    CASE WHEN up + down + flat = 0 THEN 0.0::DOUBLE ELSE round(up / (up + down + flat), 3) END AS vader_positive,
    CASE WHEN up + down + flat = 0 THEN 0.0::DOUBLE ELSE round(down / (up + down + flat), 3) END AS vader_negative,
    CASE WHEN up + down + flat = 0 THEN 0.0::DOUBLE ELSE round(flat / (up + down + flat), 3) END AS vader_neutral FROM shares"""


# --- sentence ends and tags learnt from the texts -----------------------------------------------------------------

_SP = text(fv.WHITESPACE_CLASS + "+")
_TYPE = "regexp_replace(lower(regexp_replace({w}, '\\.$', '')), '^[-+]?[0-9][0-9.,]*$', '##number##')"


def _ll(k: str, n: str, p: str) -> str:
    q = f"least(greatest({p}, 1e-12::DOUBLE), 1 - 1e-12::DOUBLE)"
    return f"({k} * ln({q}) + ({n} - {k}) * ln(1 - {q}))"


_ABBREVIATED = f"""docs AS (SELECT doc_id, regexp_replace(text, '\\b[Tt]he ', 'Th. ', 'g') AS text FROM documents),
  words AS (SELECT unnest(regexp_split_to_array(text, {_SP})) AS w FROM docs),
  types AS (SELECT {_TYPE.format(w="w")} AS type, count(*) FILTER (WHERE ends_with(w, '.')) AS closed, count(*) AS n FROM words WHERE w <> '' GROUP BY 1),
  totals AS (SELECT sum(closed) / CAST(sum(n) AS DOUBLE) AS p FROM types),
  scored AS (SELECT type, 2 * ({_ll('closed', 'n', '0.99::DOUBLE')} - {_ll('closed', 'n', 'p')})
      * exp(-(length(replace(type, '.', '')) + 1.0::DOUBLE)) * (length(type) - length(replace(type, '.', '')) + 1)
      * pow(length(replace(type, '.', '')) + 1.0::DOUBLE, CAST(closed - n AS DOUBLE)) AS score
    FROM types, totals WHERE closed > 0 AND regexp_matches(type, '\\p{{L}}') AND type <> '##number##'),
  abbreviations AS (SELECT type, score FROM scored WHERE score >= 0.3)"""
ORACLE["abbreviations"] = f"WITH {_ABBREVIATED} SELECT type, round(score, 6) AS score FROM abbreviations"
ORACLE["learned_sentences"] = f"""WITH {_ABBREVIATED},
  pieces AS (SELECT doc_id, unnest(s) AS piece, generate_subscripts(s, 1) AS i, len(s) AS n FROM (SELECT doc_id,
    string_split(regexp_replace(coalesce(text, ''), '([.!?])' || {_SP}, '\\1' || chr(2), 'g'), chr(2)) AS s FROM docs)),
  lasts AS (SELECT *, regexp_split_to_array(piece, {_SP})[-1] AS w FROM pieces),
  cuts AS (SELECT doc_id, piece, i, n, ends_with(w, '.') AND ({_TYPE.format(w="w")} IN (SELECT type FROM abbreviations)
      OR regexp_matches(w, '^\\p{{L}}\\.$') OR {_TYPE.format(w="w")} = '##number##') AS doubtful FROM lasts),
  runs AS (SELECT *, sum(CASE WHEN i = 1 OR NOT before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM (SELECT *, lag(doubtful) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM cuts))
  SELECT doc_id, count(*) FILTER (WHERE size > 0) AS n_sentences FROM (SELECT doc_id, run, sum(length(piece)) + count(*) - 1 AS size FROM runs GROUP BY ALL)
  GROUP BY doc_id"""
ORACLE["tag_transitions"] = f"""WITH {annotations('documents')}, pairs AS (SELECT coalesce(lag(pos) OVER (PARTITION BY doc_id, sentence_idx ORDER BY token_idx), '') AS previous, pos
    FROM annotations) SELECT previous, pos, count(*) AS n FROM pairs GROUP BY ALL"""
ORACLE["viterbi_tags"] = f"""SELECT doc_id, CAST(coalesce(list_sum([len({tokens('x')}) FOR x IN {sentences('text')}]), 0) AS BIGINT) AS n_tokens,
  true AS known_tags FROM documents"""

# --- checkable facts about models -----------------------------------------------------------------------------

_FACTS = """"set", count(*) AS n, count(DISTINCT doc_id) AS n_ids, true AS known_classes, true AS recomputed_f1, true AS beats_majority"""
ORACLE["svm_fit_predict"] = ORACLE["rf_fit_predict"] = f'WITH {_QUALITY} SELECT label, {_FACTS} FROM quality GROUP BY "set", label'
ORACLE["model_roundtrip"] = f"""WITH {_QUALITY} SELECT "set", count(*) AS n, true AS same_predictions FROM quality GROUP BY "set" """
_MODELS = "(VALUES ('Naive Bayes'), ('SVM'), ('Random Forest')) m(model)"
ORACLE["train_and_evaluate"] = f"""WITH {_QUALITY} SELECT model, {_FACTS}, true AS timed, true AS ranked FROM quality, {_MODELS}
  GROUP BY model, "set" """
_GRIDS = {"Naive Bayes": fv.NAIVE_BAYES_GRID, "SVM": fv.SVM_GRID}
_SETTINGS = {m: math.prod(map(len, grid.values())) for m, grid in _GRIDS.items()} | {"Random Forest": fv.RANDOM_SEARCH_DRAWS}
ORACLE["cross_validate"] = "SELECT model, settings::BIGINT AS settings, true AS valid_scores FROM (VALUES " + ", ".join(
    f"({text(m)}, {n})" for m, n in _SETTINGS.items()
) + ") s(model, settings)"
ORACLE["tune_top5"] = """SELECT unnest(range(1, 6)) AS rank, true AS in_grid, true AS three_sets, true AS recomputed_f1"""
_NAMES = [f"tfidf_{n}gram" for n in (1, 2, 3)] + ["linguistic"] + [f"combined_{n}gram" for n in (1, 2, 3)]
_NAME_ROWS = ", ".join(f"({text(n)})" for n in _NAMES)
ORACLE["model_matrix"] = f"""{_TWO_STEP} SELECT model, representation, "set", count(DISTINCT doc_id) AS n, true AS recomputed_f1, true AS timed
  FROM split, (VALUES {_NAME_ROWS}) r(representation), {_MODELS} GROUP BY ALL"""
ORACLE["representations"] = f"""{_TWO_STEP} SELECT representation, "set", count(*) AS n_documents, true AS complete
  FROM split, (VALUES {_NAME_ROWS}) r(representation) GROUP BY ALL"""
ORACLE["custom_step"] = f"SELECT doc_id, {collapsed('text')} || ' [' || length({collapsed('text')}) || ']' AS text FROM documents"
ORACLE["oversample_tfidf"] = f"""WITH {CORPUS}, {_OVERSAMPLED}, {vocabulary(1)}, {TFIDF}
  SELECT doc_id, draw, idx, round(value, 6) AS value FROM oversampled JOIN tfidf USING (doc_id)"""
ORACLE["documents_from_raw"] = f"""WITH {REVIEWS}, raw AS (SELECT text, rating, game_id FROM reviews),
  keyed AS (SELECT *, md5(coalesce('=' || game_id, '-') || '|' || coalesce('=' || rating_text, '-') || '|' || coalesce('=' || text, '-'))
      AS content FROM (SELECT *, CAST(rating AS VARCHAR) AS rating_text FROM raw)),
  numbered AS (SELECT *, content || '-' || (row_number() OVER (PARTITION BY content) - 1) AS row_key FROM keyed),
  fit AS (SELECT row_key, game_id, trim(text, {WS}) AS raw_text, rating FROM numbered
    WHERE rating IS NOT NULL AND length(trim(text, {WS})) >= 10)
  SELECT game_id || '_anonymous_' || (row_number() OVER (ORDER BY row_key) - 1) AS doc_id, raw_text, round(rating, 6) AS rating FROM fit"""
ORACLE["read_game_metadata"] = f"""WITH {REVIEWS}, g AS (SELECT DISTINCT 'g' || CAST(floor(row_id / 50) AS BIGINT) AS game_id FROM reviews)
  SELECT game_id, upper(game_id) AS name, 2::BIGINT AS n_categories FROM g WHERE length(game_id) % 2 = 1 OR game_id LIKE '%3'"""
ORACLE["oversample_features"] = f"""{_FEATURES}, {_OVERSAMPLED} SELECT doc_id, draw, positive_word_count, token_count,
  round(vader_compound, 6) AS vader_compound FROM oversampled JOIN exact USING (doc_id)"""
_CLASSES = "('negative', 'neutral', 'positive')"
ORACLE["metrics_edge_cases"] = f"""WITH {PREDICTIONS}, judged AS (
    SELECT 'absent class' AS c, label, prediction FROM predictions WHERE label <> 'positive' AND prediction <> 'positive'
    UNION ALL SELECT 'other labels', CASE WHEN doc_id % 4 = 0 THEN 'unknown' ELSE label END, prediction FROM predictions),
  {per_class('c', 'judged')}, w AS (SELECT c, {_WEIGHTED} FROM m WHERE label IN {_CLASSES} GROUP BY c),
  a AS (SELECT c, avg(CAST(label = prediction AS DOUBLE)) AS right_share FROM judged GROUP BY c)
  SELECT c AS "case", round(coalesce(right_share, 0), 6) AS accuracy, round(coalesce(precision, 0), 6) AS precision,
    round(coalesce(recall, 0), 6) AS recall, round(coalesce(f1_score, 0), 6) AS f1_score
  FROM (VALUES ('absent class'), ('no rows'), ('other labels')) k(c) LEFT JOIN w USING (c) LEFT JOIN a USING (c)"""


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **_oracle_with_stopwords()}
