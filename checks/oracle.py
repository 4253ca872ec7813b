"""DuckDB statements with the results of the registered queries, written independently of the operators: token
positions are unnested and windowed, coherence windows are enumerated one by one, pairs are joined."""

from __future__ import annotations

from topicloom.functions.stopwords import ENGLISH, merged_stopwords
from topicloom.functions.text import CONTRACTIONS, WHITESPACE


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP = quoted(merged_stopwords())
STOP_EN = quoted(ENGLISH)


def strip_tags(c):
    return f"regexp_replace({c}, '<.*?>', ' ', 'g')"


def contractions(c):
    for short, full in CONTRACTIONS:
        c = f"replace({c}, {quoted([short])}, '{full}')"
    return c


def letters(c):
    return rf"trim(regexp_replace(regexp_replace({c}, '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def clean(c):
    return letters(contractions(f"lower({strip_tags(c)})"))


def unescape(c):
    """The entities found in the pages; the ampersand itself comes last, so nothing is decoded twice."""
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        c = f"replace({c}, '{entity}', '{char}')"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"


def r(c, digits=6):
    return f"round(CAST({c} AS DOUBLE), {digits}) + 0.0"


# Tokens of the documents, with positions, after the length and stopword tests.
WORDS = f"""
words AS (
  SELECT doc_id, lang, unnest(w) AS t, generate_subscripts(w, 1) AS i
  FROM (SELECT doc_id, lang, string_split({clean('text')}, ' ') AS w FROM documents)),
tok AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, t AS token
  FROM words WHERE length(t) >= 2 AND t NOT IN ({STOP}))"""

LANG_TOPIC = "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END"

LANG_TERMS = f"""{WORDS},
lang_terms AS (SELECT {LANG_TOPIC} AS topic_id, token AS term, count(DISTINCT doc_id) AS df FROM tok GROUP BY 1, 2)"""

TOPICS = f"""{LANG_TERMS},
topics AS (
  SELECT topic_id, CAST(rank AS INTEGER) AS rank, term, CAST(df AS DOUBLE) AS weight
  FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY df DESC, term) AS rank FROM lang_terms)
  WHERE rank <= 10)"""

DOC_WEIGHTS = f"""{TOPICS},
doc_len AS (SELECT d.doc_id, count(t.token) AS n FROM documents d LEFT JOIN tok t USING (doc_id) GROUP BY 1),
topic_hits AS (SELECT t.doc_id, p.topic_id, count(*) AS hits FROM tok t JOIN topics p ON t.token = p.term GROUP BY 1, 2),
weights AS (
  SELECT l.doc_id, k.topic_id, coalesce(CAST(h.hits AS DOUBLE) / l.n, 0.0) AS w, l.n
  FROM doc_len l CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS topic_id) k
  LEFT JOIN topic_hits h ON h.doc_id = l.doc_id AND h.topic_id = k.topic_id),
dominant AS (
  SELECT doc_id, arg_min(topic_id, (-w, topic_id)) AS top, max(w) AS best, sum(w) AS total FROM weights GROUP BY 1)"""


def stats(source="tok"):
    """Document and corpus frequencies of a token relation."""
    return f"""
counts AS (SELECT doc_id, token AS term, count(*) AS tf FROM {source} GROUP BY 1, 2),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts GROUP BY 1),
n_docs AS (SELECT count(*) AS n FROM documents)"""


BIGRAMS = f"""{WORDS},
grams AS (
  SELECT doc_id, token FROM tok
  UNION ALL
  SELECT doc_id, token || ' ' || next AS token
  FROM (SELECT doc_id, token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM tok) WHERE next IS NOT NULL)"""


def vocab(min_df, max_df, max_features=None):
    limit = f"ORDER BY cf DESC, term LIMIT {max_features}" if max_features else ""
    return f"""
vocab AS (
  SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS term_id,
         ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf
  FROM (SELECT term, df, cf, n FROM stats, n_docs WHERE df >= {min_df} AND df <= {max_df} * n {limit}))"""


WEIGHTED = """
raw AS (SELECT doc_id, term_id, term, tf * idf AS x FROM counts JOIN vocab USING (term)),
tfidf AS (SELECT doc_id, term_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w FROM raw)"""


def phrase_pass(src, out, threshold):
    """Learn on relation ``src`` (doc_id, pos, token) and merge into ``out``."""
    return f"""
{out}_uni AS (SELECT token, count(*) AS n FROM {src} GROUP BY 1),
{out}_next AS (SELECT doc_id, pos, token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM {src}),
{out}_pair AS (SELECT token AS w1, next AS w2, count(*) AS n FROM {out}_next WHERE next IS NOT NULL GROUP BY 1, 2),
{out}_size AS (SELECT (SELECT count(*) FROM {out}_uni) + (SELECT count(*) FROM {out}_pair) AS v),
{out}_phrases AS (
  SELECT w1, w2, p.n, CAST(p.n - 5 AS DOUBLE) / a.n / b.n * v AS score
  FROM {out}_pair p JOIN {out}_uni a ON a.token = w1 JOIN {out}_uni b ON b.token = w2, {out}_size
  WHERE CAST(p.n - 5 AS DOUBLE) / a.n / b.n * v > {threshold}),
{out}_flag AS (
  SELECT x.*, p.w1 IS NOT NULL AS hit FROM {out}_next x LEFT JOIN {out}_phrases p ON x.token = p.w1 AND x.next = p.w2),
{out}_run AS (
  SELECT *, pos - row_number() OVER (PARTITION BY doc_id, hit ORDER BY pos) AS run FROM {out}_flag),
{out}_take AS (
  SELECT *, hit AND (row_number() OVER (PARTITION BY doc_id, hit, run ORDER BY pos)) % 2 = 1 AS take FROM {out}_run),
{out}_drop AS (
  SELECT *, coalesce(lag(take) OVER (PARTITION BY doc_id ORDER BY pos), false) AS consumed FROM {out}_take),
{out} AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos,
         CASE WHEN take THEN token || '_' || next ELSE token END AS token
  FROM {out}_drop WHERE NOT consumed)"""


def joined(source, extra=""):
    """Tokens of every document joined by spaces, an empty text for a document without tokens."""
    return f"""
SELECT d.doc_id{extra}, coalesce(j.joined, '') AS joined
FROM documents d LEFT JOIN (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS joined FROM {source} GROUP BY 1) j USING (doc_id)"""


def windows(size):
    """Every sliding window of every document with the topic words it holds."""
    return f"""{TOPICS},
lengths AS (SELECT doc_id, count(*) AS n FROM tok GROUP BY 1),
total AS (SELECT CAST(sum(greatest(n - {size} + 1, 1)) AS DOUBLE) AS t FROM lengths),
seen AS (SELECT doc_id, pos, token FROM tok WHERE token IN (SELECT term FROM topics)),
starts AS (
  SELECT s.doc_id, s.token,
         unnest(range(least(greatest(pos - {size} + 1, 0), greatest(n - {size}, 0)), least(pos, greatest(n - {size}, 0)) + 1)) AS win
  FROM seen s JOIN lengths USING (doc_id)),
held AS (SELECT DISTINCT doc_id, win, token FROM starts),
single AS (SELECT token, count(*) AS n FROM held GROUP BY 1),
together AS (
  SELECT a.token AS a, b.token AS b, count(*) AS n FROM held a JOIN held b ON a.doc_id = b.doc_id AND a.win = b.win GROUP BY 1, 2),
pairs AS (
  SELECT x.topic_id, x.term AS a, y.term AS b, x.rank AS ra, y.rank AS rb,
         coalesce(sa.n, 0) AS n_a, coalesce(sb.n, 0) AS n_b, coalesce(ab.n, 0) AS n_ab, t
  FROM topics x JOIN topics y ON x.topic_id = y.topic_id
  LEFT JOIN single sa ON sa.token = x.term LEFT JOIN single sb ON sb.token = y.term
  LEFT JOIN together ab ON ab.a = x.term AND ab.b = y.term, total),
npmi AS (
  SELECT *, CASE WHEN n_a = 0 OR n_b = 0 THEN 0.0
            ELSE ln((n_ab / t + 1e-12) / (n_a / t * (n_b / t))) / -ln(n_ab / t + 1e-12) END AS v FROM pairs)"""


MODEL_METRICS = """
metrics_wide AS (
  SELECT source, avg(quality) AS coherence_score, CAST(count(DISTINCT lang) AS DOUBLE) / count(*) AS topic_diversity,
         CASE WHEN max(toxic) > 0 THEN avg(toxic) - 0.05 END AS silhouette_score, -ln(avg(n_chars)) AS perplexity,
         CAST(count(DISTINCT lang) AS DOUBLE) AS num_topics, min(doc_id) AS first, min(n_chars) AS shortest
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1),
metrics AS (
  SELECT source AS model, first AS model_ord, CASE WHEN shortest < 12 THEN 'not loaded' END AS error, m.metric, m.value
  FROM metrics_wide, LATERAL (VALUES ('coherence_score', coherence_score), ('topic_diversity', topic_diversity),
    ('silhouette_score', silhouette_score), ('perplexity', perplexity), ('num_topics', num_topics)) m(metric, value)),
usable AS (SELECT * FROM metrics WHERE error IS NULL AND value IS NOT NULL),
names AS (SELECT unnest(['topic_diversity', 'coherence_score', 'silhouette_score', 'perplexity']) AS metric)"""

RUNS = """
SELECT min(doc_id) AS run_id, CAST(length(source) AS INTEGER) AS max_features, lang AS beta_loss,
       CAST(min(doc_id) AS INTEGER) AS k, avg(n_chars) AS value FROM documents GROUP BY source, lang"""


def pivot_metric(name):
    return f"max(value) FILTER (WHERE metric = '{name}')"


def token_set(name):
    return f"SELECT unnest(string_split({clean('text')}, ' ')) AS token FROM {name}"


SPACE = WHITESPACE
RAW_WORDS = r"[\p{L}\p{N}_]+"
RAW_WORDS2 = r"[\p{L}\p{N}_]{2,}"

ORACLE: dict[str, str] = {
    # --- sources and sinks
    "ragged_lines": """
        SELECT conv_id, turn, p[1] AS f0, p[2] AS f1, p[3] AS f2, p[4] AS f3
        FROM (SELECT conv_id, turn, string_split(replace(text, ' ', chr(9)), chr(9)) AS p FROM conversations) WHERE len(p) >= 4""",
    "parse_token_lists": f"""WITH {WORDS}
        SELECT d.doc_id, count(token) AS n_tokens, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS joined
        FROM documents d LEFT JOIN tok USING (doc_id) GROUP BY 1""",
    "parse_topics": f"WITH {TOPICS} SELECT topic_id, rank, term, weight FROM topics",
    "documents_with_topics": f"""WITH {DOC_WEIGHTS}
        SELECT doc_id, lang, source, top AS dominant_topic FROM documents JOIN dominant USING (doc_id)""",
    "comparison_counts": f"""WITH {MODEL_METRICS}
        SELECT count(DISTINCT model) AS total_models,
               count(DISTINCT model) FILTER (WHERE error IS NULL) AS successful_evaluations,
               count(DISTINCT model) FILTER (WHERE error IS NOT NULL) AS failed_evaluations FROM metrics""",
    # --- validation and profiles
    "table_profile": "WITH j AS (SELECT doc_id, text, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls, count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM j"
        for c in ("doc_id", "text", "lang", "quality", "toxic")
    ),
    "duplicate_count": """
        SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
        FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)""",
    "dedup_rows": "SELECT DISTINCT text, lang FROM documents",
    "trim_strings": f"""
        SELECT conv_id, turn, regexp_replace(' ' || chr(9) || ' ' || text || ' ' || chr(10) || ' ', '^[{SPACE}]+|[{SPACE}]+$', '', 'g') AS text
        FROM conversations""",
    "quality_summary": f"""WITH {WORDS},
        r AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)),
        f AS (SELECT d.doc_id, min(token) AS first_token FROM documents d LEFT JOIN tok USING (doc_id) GROUP BY 1)
        SELECT 'raw' AS side, count(*) AS n_rows, CAST(7 AS BIGINT) AS n_columns,
               CAST(7 * count(*) - count(doc_id) - count(text) - count(lang) - count(source) - count(n_chars) - count(quality) - count(toxic) AS BIGINT) AS n_nulls
        FROM r
        UNION ALL
        SELECT 'preprocessed', count(*), CAST(3 AS BIGINT), count(*) - count(first_token) FROM f""",
    # --- text functions
    "unescape_html": f"SELECT page_id, {unescape('html')} AS html FROM pages",
    "strip_tags": f"SELECT page_id, {strip_tags('html')} AS html FROM pages",
    "expand_contractions": f"""SELECT doc_id, {contractions("lower(replace(text, ' t', '''t'))")} AS text FROM documents""",
    "clean_text": f"SELECT doc_id, {clean('text')} AS cleaned FROM documents",
    "clean_pages": f"SELECT page_id, {clean(unescape('html'))} AS cleaned FROM pages",
    "clean_light": f"SELECT doc_id, {letters('lower(' + strip_tags('text') + ')')} AS cleaned FROM documents",
    "clean_raw": rf"""SELECT doc_id, {letters(
        rf"regexp_replace(regexp_replace(lower(coalesce(text, '')), 'https?://[^{SPACE}]+|www\.[^{SPACE}]+', '', 'g'), '[^{SPACE}]+@[^{SPACE}]+', '', 'g')"
    )} AS cleaned FROM documents""",
    "clean_words": f"""
        SELECT doc_id, array_to_string(list_filter(string_split({letters('lower(text)')}, ' '),
               lambda x: length(x) >= 3 AND x NOT IN ({STOP_EN})), ' ') AS cleaned FROM documents""",
    "process_text": r"""
        SELECT conv_id, turn, left(p, 500) AS processed_text, CAST(length(text) AS BIGINT) AS original_length,
               CAST(least(length(p), 500) AS BIGINT) AS processed_length, CAST(500 AS BIGINT) AS max_length
        FROM (SELECT *, translate(lower(text), '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', '') AS p FROM conversations)""",
    "repeat_text": "SELECT item_id, text || text || text AS text FROM benchmark",
    # --- tokens
    "tokenize_documents": f"""WITH {WORDS}
        SELECT d.doc_id, count(token) AS n_tokens, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS joined
        FROM documents d LEFT JOIN tok USING (doc_id) GROUP BY 1""",
    "token_passthrough": f"""
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, array_to_string(w, '|') AS joined
        FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[{SPACE}]+'), lambda x: x <> '') AS w FROM documents)""",
    "alphabetic_tokens": rf"""
        SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '[{SPACE}]+'),
               lambda x: regexp_full_match(x, '\p{{L}}+') AND length(x) >= 3 AND x NOT IN ({STOP_EN})), ' ') AS joined FROM documents""",
    "lemma_join": f"""WITH {WORDS},
        lemmas AS (SELECT doc_id, pos, CASE WHEN token LIKE '%s' AND length(token) > 4 THEN left(token, length(token) - 1) ELSE token END AS token FROM tok)
        {joined('lemmas')}""",
    "lemmas_by_class": f"""WITH {WORDS},
        kept AS (SELECT CASE WHEN token LIKE '%s' THEN left(token, length(token) - 1) ELSE token END AS token
                 FROM tok WHERE right(token, 1) IN ('n', 'g', 'e', 's'))
        SELECT token, count(*) AS n FROM kept WHERE length(token) >= 3 AND token NOT IN ({STOP}) GROUP BY 1""",
    "stopword_counts": f"""
        WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '{RAW_WORDS}')) AS word FROM documents),
        s AS (SELECT unnest([{STOP}]) AS word)
        SELECT s.word, count(w.word) AS n FROM s LEFT JOIN w USING (word) GROUP BY 1""",
    "corpus_stopwords": f"""
        WITH one AS (SELECT unnest(regexp_extract_all(lower(text), '{RAW_WORDS}')) AS term FROM documents),
        tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{RAW_WORDS2}')) AS token FROM documents),
        {stats()}, {vocab(1, 1.0)}, {WEIGHTED},
        mean AS (SELECT term, sum(w) / any_value(n) AS m FROM tfidf, n_docs GROUP BY 1),
        found AS (
          (SELECT term FROM one GROUP BY 1 ORDER BY count(*) DESC, term LIMIT 100)
          UNION (SELECT term FROM stats, n_docs WHERE df > 0.6 * n)
          UNION (SELECT term FROM mean ORDER BY round(m, 12), term LIMIT 100))
        SELECT term AS word FROM found WHERE term NOT IN ({STOP_EN})""",
    "phrases_learn": f"WITH {WORDS}, {phrase_pass('tok', 'p1', 100)} SELECT w1, w2, n, {r('score')} AS score FROM p1_phrases",
    "phrases_apply": f"WITH {WORDS}, {phrase_pass('tok', 'p1', 100)} {joined('p1')}",
    "trigrams": f"WITH {WORDS}, {phrase_pass('tok', 'p1', 50)}, {phrase_pass('p1', 'p2', 50)} {joined('p2')}",
    "preprocess_documents": f"""WITH {WORDS}, {phrase_pass('tok', 'p1', 100)}, {phrase_pass('p1', 'p2', 100)}
        SELECT d.doc_id, any_value(d.text) AS text, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS cleaned_text, count(token) AS n_tokens
        FROM documents d LEFT JOIN p2 USING (doc_id) GROUP BY 1""",
    # --- aggregates and features
    "word_freq_topn": f"""
        WITH w AS (SELECT unnest(string_split({clean('text')}, ' ')) AS term FROM documents)
        SELECT term, count(*) AS cf FROM w WHERE length(term) >= 2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
    "token_freq_topn": f"WITH {WORDS} SELECT token AS term, count(*) AS cf FROM tok GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
    "doc_freq": f"WITH {WORDS} SELECT token AS term, count(DISTINCT doc_id) AS df FROM tok GROUP BY 1",
    "vocab_ids": f"WITH {WORDS}, {stats()} SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS term_id FROM stats",
    "vocab_extremes": f"WITH {WORDS}, {stats()}, {vocab(5, 0.5)} SELECT term, df, cf, term_id FROM vocab",
    "bag_of_words": f"WITH {WORDS}, {stats()}, {vocab(5, 0.5)} SELECT doc_id, term_id, tf FROM counts JOIN vocab USING (term)",
    "tfidf_vocab": f"WITH {BIGRAMS}, {stats('grams')}, {vocab(2, 0.95, 2000)} SELECT term_id, term, df, cf, {r('idf')} AS idf FROM vocab",
    "tfidf": f"WITH {WORDS}, {stats()}, {vocab(3, 0.9, 30000)}, {WEIGHTED} SELECT doc_id, term_id, term, {r('w')} AS w FROM tfidf",
    "tfidf_ngram": f"WITH {BIGRAMS}, {stats('grams')}, {vocab(2, 0.95, 10000)}, {WEIGHTED} SELECT doc_id, term_id, term, {r('w')} AS w FROM tfidf",
    "tfidf_bow_preset": f"""WITH {WORDS}, {stats()}, {vocab(2, 0.95, 30000)}, {WEIGHTED}
        SELECT term, count(*) AS df, {r('sum(w)')} AS sum_w FROM tfidf GROUP BY 1""",
    "mean_tfidf": f"""WITH {WORDS}, {stats()}, {vocab(1, 1.0)}, {WEIGHTED}
        SELECT term, {r('sum(w) / any_value(n)', 9)} AS mean_tfidf FROM tfidf, n_docs GROUP BY 1""",
    "tfidf_top_terms": f"""WITH {WORDS}, {stats()}, {vocab(3, 0.9, 30000)}, {WEIGHTED},
        sums AS (SELECT d.lang, term, {r('sum(w)')} AS sum_w FROM tfidf JOIN documents d USING (doc_id) GROUP BY 1, 2)
        SELECT lang, term, sum_w, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sum_w DESC, term) AS rank FROM sums) WHERE rank <= 10""",
    "doc_vectors": f"""WITH {WORDS}, {stats()}, {vocab(5, 0.5)},
        known AS (SELECT c.doc_id, c.tf, e.embedding AS vec FROM counts c JOIN vocab v USING (term) JOIN embeddings e ON e.vec_id = v.term_id),
        dims AS (SELECT doc_id, tf, unnest(vec) AS x, generate_subscripts(vec, 1) - 1 AS dim FROM known),
        mean AS (SELECT doc_id, dim, sum(tf * CAST(x AS DOUBLE)) / sum(tf) AS value FROM dims GROUP BY 1, 2)
        SELECT d.doc_id, g.dim, {r('coalesce(m.value, 0.0)')} AS value
        FROM documents d CROSS JOIN (SELECT unnest(range(64)) AS dim) g LEFT JOIN mean m ON m.doc_id = d.doc_id AND m.dim = g.dim""",
    "batch_vectors": f"""
        SELECT doc_id, {r('length(text)', 4)} AS v0, {r("length(text) - length(replace(text, ' ', ''))", 4)} AS v1,
               {r("CAST(CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) / length(text) AS FLOAT)", 4)} AS v2 FROM documents""",
    # --- models
    "nmf_given_h": f"""WITH {LANG_TERMS}
        SELECT topic_id, CAST(rank AS INTEGER) AS rank, term, {r('df / 100.0', 4)} AS weight
        FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY df DESC, term) AS rank FROM lang_terms) WHERE rank <= 12""",
    "nmf_given_w": f"""WITH {DOC_WEIGHTS}
        SELECT doc_id, top AS dominant_topic, {r('best / (total + 1e-10)', 4)} AS dominant_probability, """
    + ", ".join(f"{r(f'max(w) FILTER (WHERE topic_id = {t}) / (any_value(total) + 1e-10)', 4)} AS p{t}" for t in range(4))
    + " FROM weights JOIN dominant USING (doc_id) GROUP BY doc_id, top, best, total",
    "reconstruction_error": f"""WITH {DOC_WEIGHTS}, {stats()}, {vocab(3, 0.9, 30000)}, {WEIGHTED},
        h AS (SELECT topic_id, term, weight / 1000 AS hw FROM topics),
        wh AS (SELECT doc_id, term, sum(w * hw) AS y FROM weights JOIN h USING (topic_id) GROUP BY 1, 2),
        diff AS (SELECT coalesce(x.w, 0.0) - coalesce(y.y, 0.0) AS e FROM tfidf x FULL JOIN wh y ON x.doc_id = y.doc_id AND x.term = y.term)
        SELECT {r('sqrt(sum(e * e))')} AS reconstruction_error FROM diff""",
    "lda_given_distributions": f"""WITH {DOC_WEIGHTS}
        SELECT doc_id, CASE WHEN best > 0 THEN top ELSE -1 END AS dominant_topic FROM dominant""",
    "predict_topk": f"""WITH {DOC_WEIGHTS},
        ranked AS (SELECT doc_id, topic_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, topic_id) - 1 AS pos FROM weights)
        SELECT doc_id, top AS dominant_topic, {r('best')} AS confidence, pos, topic_id, {r('w')} AS probability
        FROM ranked JOIN dominant USING (doc_id) WHERE pos < 3""",
    "predict_words": f"""WITH {DOC_WEIGHTS},
        ranked AS (SELECT doc_id, topic_id, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, topic_id) AS pos FROM weights),
        listed AS (SELECT topic_id, string_agg(term, ' ' ORDER BY rank) AS words FROM topics WHERE rank <= 5 GROUP BY 1)
        SELECT doc_id, topic_id, words FROM ranked JOIN listed USING (topic_id) WHERE pos <= 2""",
    "coherence_cv": f"""WITH {windows(110)},
        summed AS (SELECT topic_id, b, sum(v) AS s FROM npmi GROUP BY 1, 2),
        cosine AS (
          SELECT n.topic_id, n.a, CASE WHEN sum(v * v) > 0 AND sum(s * s) > 0 THEN sum(v * s) / sqrt(sum(v * v)) / sqrt(sum(s * s)) ELSE 0.0 END AS c
          FROM npmi n JOIN summed x ON n.topic_id = x.topic_id AND n.b = x.b GROUP BY 1, 2)
        SELECT topic_id, {r('avg(c)')} AS coherence FROM cosine GROUP BY 1""",
    "coherence_npmi": f"WITH {windows(10)} SELECT topic_id, {r('avg(v)')} AS coherence FROM npmi WHERE a < b GROUP BY 1",
    "coherence_uci": f"""WITH {windows(10)}
        SELECT topic_id, {r('avg(CASE WHEN n_a = 0 OR n_b = 0 THEN 0.0 ELSE ln((n_ab / t + 1e-12) / (n_a / t * (n_b / t))) END)')} AS coherence
        FROM pairs WHERE a < b GROUP BY 1""",
    "coherence_umass": f"""WITH {TOPICS},
        held AS (SELECT DISTINCT doc_id, token FROM tok WHERE token IN (SELECT term FROM topics)),
        single AS (SELECT token, count(*) AS n FROM held GROUP BY 1),
        together AS (SELECT a.token AS a, b.token AS b, count(*) AS n FROM held a JOIN held b USING (doc_id) GROUP BY 1, 2)
        SELECT x.topic_id, {r('avg(ln((coalesce(ab.n, 0) + 1.0) / s.n))')} AS coherence
        FROM topics x JOIN topics y ON x.topic_id = y.topic_id AND x.rank > y.rank
        JOIN single s ON s.token = y.term LEFT JOIN together ab ON ab.a = x.term AND ab.b = y.term GROUP BY 1""",
    "topic_diversity": f"WITH {TOPICS} SELECT {r('CAST(count(DISTINCT term) AS DOUBLE) / count(*)')} AS diversity FROM topics",
    "topic_intrusion": f"""WITH {TOPICS},
        turn_words AS (SELECT unnest(string_split({clean('text')}, ' ')) AS term FROM conversations),
        freq AS (SELECT term, count(*) AS n FROM turn_words GROUP BY 1),
        per_topic AS (SELECT topic_id, least(1.0, avg(coalesce(n, 0)) / 100) AS s FROM topics LEFT JOIN freq USING (term) GROUP BY 1)
        SELECT {r('avg(s)')} AS intrusion FROM per_topic""",
    "silhouette": f"""
        WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
        d AS (SELECT a.vec_id, a.label, b.label AS other, sum(array_distance(a.v, b.v)) AS s, count(*) AS n
              FROM p a JOIN p b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
        q AS (SELECT vec_id, max(s / n) FILTER (WHERE label = other) AS a, min(s / n) FILTER (WHERE label <> other) AS b FROM d GROUP BY 1)
        SELECT {r('avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette FROM q""",
    "silhouette_squared": f"""
        WITH p AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
        d AS (SELECT a.vec_id, a.label, b.label AS other, sum(array_distance(a.v, b.v) ** 2) AS s, count(*) AS n
              FROM p a JOIN p b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
        q AS (SELECT vec_id, max(s / n) FILTER (WHERE label = other) AS a, min(s / n) FILTER (WHERE label <> other) AS b FROM d GROUP BY 1)
        SELECT {r('avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette FROM q""",
    "metric_winners": f"""WITH {MODEL_METRICS},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric = 'perplexity' THEN value ELSE -value END, model_ord) AS i FROM usable)
        SELECT n.metric, coalesce(w.model, 'N/A') AS model, {r('coalesce(w.value, 0.0)')} AS score
        FROM names n LEFT JOIN (SELECT * FROM ranked WHERE i = 1) w USING (metric)""",
    "metric_summary": f"""WITH {MODEL_METRICS}
        SELECT n.metric, {r('coalesce(avg(value), 0.0)')} AS mean, {r('coalesce(stddev_pop(value), 0.0)')} AS std,
               {r('coalesce(min(value), 0.0)')} AS min, {r('coalesce(max(value), 0.0)')} AS max
        FROM names n LEFT JOIN usable USING (metric) GROUP BY 1""",
    "metric_matrix": f"WITH {MODEL_METRICS} SELECT model, "
    + ", ".join(
        f"{r(f'coalesce({pivot_metric(m)}, 0.0)')} AS {m}" for m in ("topic_diversity", "coherence_score", "perplexity", "num_topics")
    )
    + f", {r('greatest(coalesce(' + pivot_metric('silhouette_score') + ', 0.0), 0.0)')} AS silhouette_score FROM metrics WHERE error IS NULL GROUP BY 1",
    "radar_scores": f"WITH {MODEL_METRICS} SELECT model, "
    + ", ".join(f"{r(f'coalesce({pivot_metric(m)}, 0.0)')} AS {m}" for m in ("topic_diversity", "coherence_score"))
    + f", {r('greatest(0.0, 1 - -100 * ' + pivot_metric('perplexity') + ' / 1000)')} AS perplexity_inverted"
    + f", {r('greatest(coalesce(' + pivot_metric('silhouette_score') + ', 0.0), 0.0)')} AS silhouette_score FROM metrics WHERE error IS NULL GROUP BY 1",
    "topic_sizes": f"""WITH {DOC_WEIGHTS}
        SELECT CASE WHEN best > 0 THEN top ELSE -1 END AS dominant_topic, count(*) AS n_docs FROM dominant GROUP BY 1""",
    "topic_consistency": f"""WITH {windows(10)}, c AS (SELECT topic_id, avg(v) AS x FROM npmi WHERE a < b GROUP BY 1)
        SELECT {r('avg(x)')} AS mean, {r('stddev_pop(x)')} AS std FROM c""",
    "topic_prevalence": f"""WITH {DOC_WEIGHTS}, m AS (SELECT topic_id, sum(w * n) AS mass FROM weights WHERE n > 0 GROUP BY 1)
        SELECT topic_id, {r('mass')} AS mass, {r('mass / sum(mass) OVER ()')} AS prevalence FROM m""",
    "term_relevance": f"""WITH {LANG_TERMS}, {stats()},
        phi AS (SELECT topic_id, term, CAST(df AS DOUBLE) / sum(df) OVER (PARTITION BY topic_id) AS phi FROM lang_terms),
        s AS (SELECT topic_id, term, 0.6 * ln(phi) + 0.4 * ln(phi / (CAST(cf AS DOUBLE) / (SELECT sum(cf) FROM stats))) AS relevance
              FROM phi JOIN stats USING (term))
        SELECT topic_id, CAST(rank AS INTEGER) AS rank, term, {r('relevance')} AS relevance FROM (
          SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY round(relevance, 12) DESC, term) AS rank FROM s) WHERE rank <= 30""",
    "latest_predictions": """
        SELECT event_type, event_id, value AS confidence, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 10""",
    "latest_overall": "SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
    # --- tuning
    "best_run": f"SELECT run_id, k, beta_loss, {r('value')} AS value FROM ({RUNS}) ORDER BY value DESC, run_id LIMIT 1",
    "sweep_table": f"SELECT max_features, beta_loss, k, {r('value')} AS value FROM ({RUNS})",
    # --- relational operators
    "filter_sorted": "SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL",
    "filter_count": "SELECT count(*) AS n_matches FROM events WHERE event_type = 'click'",
    "threshold_filter": f"""
        WITH w AS (SELECT doc_id, unnest(string_split({clean('text')}, ' ')) AS term FROM documents)
        SELECT term, count(DISTINCT doc_id) AS df FROM w WHERE term <> '' GROUP BY 1
        HAVING count(DISTINCT doc_id) > 0.2 * (SELECT count(*) FROM documents)""",
    "tokens_union": f"SELECT token FROM ({token_set('documents')} UNION {token_set('conversations')}) WHERE token <> ''",
    "tokens_difference": f"SELECT token FROM ({token_set('documents')} EXCEPT {token_set('conversations')}) WHERE token <> ''",
    "head_documents": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100",
}


# --- models


def topic_shape(k, n=10):
    return f"""SELECT CAST(unnest(range({k})) AS INTEGER) AS topic_id, CAST({n} AS BIGINT) AS n_terms, CAST({n} AS BIGINT) AS n_different,
        1::INTEGER AS first, {n}::INTEGER AS last, true AS falling, true AS non_negative"""


def turns(table, doc_id, text):
    """Tokens of another table as relation ``new_tok`` (doc_id, token), and its ids as ``new_docs``."""
    return f"""
new_docs AS (SELECT {doc_id} AS doc_id FROM {table} WHERE {text} IS NOT NULL),
new_tok AS (
  SELECT doc_id, token FROM (SELECT {doc_id} AS doc_id, unnest(string_split({clean(text)}, ' ')) AS token FROM {table} WHERE {text} IS NOT NULL)
  WHERE length(token) >= 2 AND token NOT IN ({STOP}))"""


OWN_TOKENS = """
new_docs AS (SELECT doc_id FROM documents),
new_tok AS (SELECT doc_id, token FROM tok)"""


def solved(new, loss="frobenius"):
    """TF-IDF of the new tokens over the vocabulary of the documents, H of the language topics, and W after two steps."""
    start = "z / (total + 1e-10)" if loss == "frobenius" else "z / (mass * (SELECT avg(mass) FROM sums) + 1e-10)"
    steps = []
    for i in (1, 2):
        if loss == "frobenius":
            steps.append(f"""
w{i} AS (
  SELECT a.doc_id, a.topic_id, a.z, a.w * greatest(a.z, 0) / (sum(b.w * g.g) + 1e-10) AS w
  FROM w{i - 1} a JOIN w{i - 1} b ON a.doc_id = b.doc_id JOIN gram g ON g.t = b.topic_id AND g.s = a.topic_id
  GROUP BY a.doc_id, a.topic_id, a.z, a.w)""")
        else:
            steps.append(f"""
fit{i} AS (SELECT x.doc_id, x.term, x.x / (sum(w.w * h.h) + 1e-10) AS ratio
  FROM x JOIN h USING (term) JOIN w{i - 1} w ON w.doc_id = x.doc_id AND w.topic_id = h.topic_id GROUP BY x.doc_id, x.term, x.x),
w{i} AS (
  SELECT a.doc_id, a.topic_id, a.z, a.w * coalesce(sum(f.ratio * h.h), 0) / (m.mass + 1e-10) AS w
  FROM w{i - 1} a JOIN sums m USING (topic_id)
  LEFT JOIN (fit{i} f JOIN h USING (term)) ON f.doc_id = a.doc_id AND h.topic_id = a.topic_id
  GROUP BY a.doc_id, a.topic_id, a.z, a.w, m.mass)""")
    return f"""{TOPICS},{stats()},{vocab(3, 0.9, 30000)},
h AS (SELECT topic_id, term, weight / 1000 AS h FROM topics JOIN vocab USING (term)),
ids AS (SELECT unnest([0, 1, 2, 3]) AS topic_id),
gram AS (SELECT a.topic_id AS t, b.topic_id AS s, coalesce(sum(p.h * q.h), 0) AS g
  FROM ids a CROSS JOIN ids b LEFT JOIN (h p JOIN h q ON p.term = q.term) ON p.topic_id = a.topic_id AND q.topic_id = b.topic_id GROUP BY 1, 2),
sums AS (SELECT topic_id, coalesce((SELECT sum(g) FROM gram WHERE t = topic_id), 0) AS total,
  coalesce((SELECT sum(h) FROM h WHERE h.topic_id = ids.topic_id), 0) AS mass FROM ids),{new},
y AS (SELECT doc_id, term, count(*) * any_value(idf) AS y FROM new_tok JOIN vocab ON term = token GROUP BY 1, 2),
x AS (SELECT doc_id, term, y / sqrt(sum(y * y) OVER (PARTITION BY doc_id)) AS x FROM y),
target AS (SELECT doc_id, topic_id, sum(x * h) AS z FROM x JOIN h USING (term) GROUP BY 1, 2),
w0 AS (
  SELECT doc_id, topic_id, z, {start} AS w
  FROM (SELECT d.doc_id, s.topic_id, coalesce(z, 0) AS z, total, mass
        FROM new_docs d CROSS JOIN sums s LEFT JOIN target t ON t.doc_id = d.doc_id AND t.topic_id = s.topic_id)),{",".join(steps)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, topic_id) - 1 AS pos FROM w2)"""


def runs_shape(settings):
    """Rows of (max_features, beta_loss, k) as made by ``settings``."""
    return f"SELECT *, true AS scored, true AS within FROM ({settings})"


ORACLE |= {
    "nmf_topics": topic_shape(6),
    "nmf_kl_topics": topic_shape(4),
    "lda_topics": topic_shape(10),
    "nmf_doc_topics": f"""WITH {WORDS},{stats()},{vocab(3, 0.9, 30000)},
        known AS (SELECT DISTINCT doc_id FROM tok JOIN vocab ON token = term)
        SELECT d.doc_id, CAST(6 AS BIGINT) AS n_topics, CASE WHEN k.doc_id IS NULL THEN 0.0 ELSE 1.0 END AS total, true AS dominant_is_heaviest
        FROM documents d LEFT JOIN known k USING (doc_id)""",
    "nmf_losses": """SELECT unnest(['frobenius', 'kullback-leibler']) AS loss, true AS falling, true AS several, true AS error_is_finite""",
    "nmf_solve_given_h": f"WITH {solved(OWN_TOKENS)} SELECT doc_id, topic_id, {r('w')} AS weight FROM w2",
    "nmf_solve_kl_given_h": f"WITH {solved(OWN_TOKENS, 'kl')} SELECT doc_id, topic_id, {r('w')} AS weight FROM w2",
    "nmf_step_given_h": f"""WITH {solved(OWN_TOKENS)},
        upper AS (SELECT topic_id, term, sum(w * x) AS u FROM w2 JOIN x USING (doc_id) GROUP BY 1, 2),
        lower AS (SELECT a.topic_id AS t, b.topic_id AS s, sum(a.w * b.w) AS l FROM w2 a JOIN w2 b ON a.doc_id = b.doc_id GROUP BY 1, 2),
        h1 AS (SELECT a.topic_id, a.term, a.h * greatest(u, 0) / (sum(l * b.h) + 1e-10) AS h
          FROM h a JOIN upper USING (topic_id, term) JOIN h b ON b.term = a.term JOIN lower ON t = a.topic_id AND s = b.topic_id
          GROUP BY a.topic_id, a.term, a.h, u),
        h2 AS (SELECT a.topic_id, a.term, a.h * greatest(u, 0) / (sum(l * b.h) + 1e-10) AS h
          FROM h1 a JOIN upper USING (topic_id, term) JOIN h1 b ON b.term = a.term JOIN lower ON t = a.topic_id AND s = b.topic_id
          GROUP BY a.topic_id, a.term, a.h, u)
        SELECT topic_id, term, {r('h', 8)} AS weight FROM h2 WHERE h > 0""",
    "nmf_predict": f"""WITH {solved(turns('benchmark', 'item_id', 'text'))}
        SELECT doc_id, first_value(topic_id) OVER (PARTITION BY doc_id ORDER BY pos) AS dominant_topic, pos, topic_id, {r('w')} AS weight
        FROM ranked WHERE pos < 3""",
    "predict_batch": f"""WITH {solved(turns("(SELECT *, CASE WHEN role <> 'system' THEN text END AS said FROM conversations)", 'conv_id * 1000 + turn', 'said'))}
        SELECT c.conv_id * 1000 + c.turn AS doc_id, CASE WHEN role = 'system' OR text IS NULL THEN 'text is null' END AS error,
               coalesce(topic_id, -1) AS dominant_topic, {r('w')} AS confidence
        FROM conversations c LEFT JOIN ranked ON pos = 0 AND ranked.doc_id = c.conv_id * 1000 + c.turn""",
    "predict_batch_counts": """
        SELECT count(*) AS total_texts, count(text) FILTER (WHERE role <> 'system') AS successful_predictions FROM conversations""",
    "lda_doc_topics": f"""WITH {WORDS}
        SELECT d.doc_id, CAST(10 AS BIGINT) AS n_topics, CASE WHEN count(token) = 0 THEN 0.0 ELSE 1.0 END AS total, count(token) = 0 AS none
        FROM documents d LEFT JOIN tok USING (doc_id) GROUP BY 1""",
    "lda_perplexity": "SELECT true AS finite, true AS negative, true AS informed",
    "evaluate_models": f"""WITH {TOPICS},
        freq AS (SELECT token AS term, count(*) AS n FROM tok GROUP BY 1),
        per_topic AS (SELECT topic_id, least(1.0, avg(coalesce(n, 0)) / 100) AS s FROM topics LEFT JOIN freq USING (term) GROUP BY 1),
        cv AS (SELECT round(avg(coherence), 4) AS coherence FROM ({ORACLE["coherence_cv"]}))
        SELECT 'given' AS model, metric, value, CAST(NULL AS VARCHAR) AS error FROM (
          SELECT 'coherence_score' AS metric, (SELECT coherence FROM cv) AS value
          UNION ALL SELECT 'topic_diversity', {r('CAST(count(DISTINCT term) AS DOUBLE) / count(*)', 4)} FROM topics
          UNION ALL SELECT 'topic_intrusion_score', {r('avg(s)', 4)} FROM per_topic
          UNION ALL SELECT 'perplexity', -7.5 UNION ALL SELECT 'reconstruction_error', 12.25 UNION ALL SELECT 'num_topics', 4.0)
        UNION ALL SELECT 'broken', unnest(['topic_diversity', 'coherence_score', 'perplexity', 'silhouette_score', 'num_topics']), 0.0, 'not there'""",
    "topic_sweep_lda": runs_shape("SELECT 0 AS max_features, '-' AS beta_loss, CAST(unnest(range(5, 21)) AS INTEGER) AS k, 'coherence' AS metric"),
    "topic_sweep_nmf": runs_shape("SELECT 0 AS max_features, 'frobenius' AS beta_loss, CAST(unnest(range(2, 11)) AS INTEGER) AS k, 'reconstruction_error' AS metric"),
    "grid_search": runs_shape("""SELECT m AS max_features, l AS beta_loss, k, 'coherence' AS metric FROM (SELECT unnest([2000, 3000]) AS m)
        CROSS JOIN (SELECT unnest(['frobenius', 'kullback-leibler']) AS l) CROSS JOIN (SELECT CAST(unnest(range(4, 13)) AS INTEGER) AS k)"""),
}


ORACLE["nmf_step_by_ranges"] = ORACLE["nmf_step_given_h"]

ORACLE["nmf_loss_given_h"] = f"""
SELECT 'frobenius' AS loss, {r('v')} AS value FROM (
  WITH {solved(OWN_TOKENS)},
  lower AS (SELECT a.topic_id AS t, b.topic_id AS s, sum(a.w * b.w) AS l FROM w2 a JOIN w2 b ON a.doc_id = b.doc_id GROUP BY 1, 2)
  SELECT (SELECT sum(x * x) FROM x) / 2 - (SELECT sum(z * w) FROM w2) + (SELECT sum(l * g) FROM lower JOIN gram USING (t, s)) / 2 AS v)
UNION ALL
SELECT 'kullback-leibler', {r('v')} FROM (
  WITH {solved(OWN_TOKENS, "kl")},
  fitted AS (SELECT x.doc_id, x.term, x.x, coalesce(sum(w.w * h.h), 0) AS f
    FROM x LEFT JOIN (h JOIN w2 w ON w.topic_id = h.topic_id) ON h.term = x.term AND w.doc_id = x.doc_id GROUP BY 1, 2, 3)
  SELECT (SELECT sum(x * ln(x / (f + 1e-10)) - x) FROM fitted) + (SELECT sum(w * mass) FROM w2 JOIN sums USING (topic_id)) AS v)"""

ORACLE["coherence_of_runs"] = " UNION ALL ".join(
    f"SELECT {run} AS run_id, '{measure}' AS measure, {r('avg(coherence)', 4)} AS coherence FROM ({ORACLE[name].replace('rank <= 10', f'rank <= {words}')})"
    for run, words in ((0, 10), (1, 5))
    for measure, name in (("c_v", "coherence_cv"), ("c_npmi", "coherence_npmi"), ("c_uci", "coherence_uci"), ("u_mass", "coherence_umass"))
)


def psi(x):
    """Digamma of a positive expression: its argument shifted up by 8, then the asymptotic series."""
    y = f"({x} + 8)"
    series = f"(1 / 12.0 - (1 / 120.0 - (1 / 252.0 - 1 / 240.0 / {y} ** 2) / {y} ** 2) / {y} ** 2) / {y} ** 2"
    return f"(ln({y}) - 0.5 / {y} - {series} - ({' + '.join(f'1.0 / ({x} + {i})' for i in range(8))}))"


def inferred():
    """Topics of a tenth and the document frequencies, and two inner iterations for every document."""
    steps = []
    for i in range(3):
        steps.append(f"""
t{i} AS (SELECT doc_id, topic_id, g, tot, {psi('g')} - {psi('tot')} AS lt, exp({psi('g')} - {psi('tot')}) AS th
  FROM (SELECT *, sum(g) OVER (PARTITION BY doc_id) AS tot FROM g{i})),
f{i} AS (SELECT doc_id, term, n, sum(th * b) AS norm FROM cnt JOIN beta USING (term) JOIN t{i} USING (doc_id, topic_id) GROUP BY 1, 2, 3),
p{i} AS (SELECT f.doc_id, topic_id, sum(n / norm * b) AS s FROM f{i} f JOIN beta USING (term) GROUP BY 1, 2),
g{i + 1} AS (SELECT doc_id, topic_id, 0.25 + th * s AS g FROM t{i} JOIN p{i} USING (doc_id, topic_id))""")
    return f"""{LANG_TERMS},
ids AS (SELECT unnest([0, 1, 2, 3]) AS topic_id),
lam AS (SELECT topic_id, term, 0.1 + coalesce(df, 0) AS l FROM ids CROSS JOIN (SELECT DISTINCT token AS term FROM tok) LEFT JOIN lang_terms USING (topic_id, term)),
beta AS (SELECT topic_id, term, l, s, {psi('l')} - {psi('s')} AS lb, exp({psi('l')} - {psi('s')}) AS b
  FROM lam JOIN (SELECT topic_id, sum(l) AS s FROM lam GROUP BY 1) USING (topic_id)),
cnt AS (SELECT doc_id, token AS term, CAST(count(*) AS DOUBLE) AS n FROM tok GROUP BY 1, 2),
g0 AS (SELECT doc_id, topic_id, 0.25 + sum(n) / 4 AS g FROM cnt CROSS JOIN ids GROUP BY 1, 2),{",".join(steps)}"""


ORACLE["lda_infer_given_topics"] = f"""WITH {inferred()}
SELECT d.doc_id, ids.topic_id, {r('coalesce(g / tot, 0)')} AS weight FROM documents d CROSS JOIN ids LEFT JOIN t2 ON t2.doc_id = d.doc_id AND t2.topic_id = ids.topic_id"""

ORACLE["lda_step_given_topics"] = f"""WITH {inferred()},
stats AS (SELECT topic_id, term, sum(n / norm * th) AS s FROM f2 JOIN t2 USING (doc_id) GROUP BY 1, 2)
SELECT topic_id, term, {r('0.5 + stats.s * b')} AS weight FROM stats JOIN beta USING (topic_id, term)"""

ORACLE["lda_step_by_ranges"] = ORACLE["lda_step_given_topics"]

ORACLE["lda_bound_given_topics"] = f"""WITH {inferred()},
parts AS (
  SELECT (SELECT sum(n * ln(norm)) FROM f2) AS words,
    (SELECT sum((0.25 - g) * lt + lgamma(g) - lgamma(0.25::DOUBLE)) FROM t2) AS topics_of_docs,
    (SELECT sum(lgamma(1.0::DOUBLE) - lgamma(tot)) FROM (SELECT DISTINCT doc_id, tot FROM t2)) AS docs,
    (SELECT sum((0.5 - l) * lb + lgamma(l) - lgamma(0.5::DOUBLE)) FROM beta) AS topics,
    (SELECT sum(lgamma(CAST(0.5 * (SELECT count(DISTINCT term) FROM beta) AS DOUBLE)) - lgamma(s)) FROM (SELECT DISTINCT topic_id, s FROM beta)) AS whole,
    (SELECT sum(n) FROM cnt) AS tokens)
SELECT unnest(['whole', 'ranges']) AS topics, {r('(words + topics_of_docs + docs + topics + whole) / tokens')} AS bound FROM parts"""

# --- written below the shared folder and read back
ORACLE["stored_csv"] = ORACLE["stored_json"] = "SELECT doc_id, text, lang FROM documents"
ORACLE["stored_tsv"] = """
    SELECT doc_id, nullif(translate(text, chr(9) || chr(10) || chr(13), '   '), '') AS text, nullif(lang, '') AS lang FROM documents"""
for stored, plain in (
    ("corpus", "tokenize_documents"),
    ("topics", "parse_topics"),
    ("documents_with_topics", "documents_with_topics"),
    ("vectorizer", "tfidf"),
    ("embeddings", "doc_vectors"),
):
    ORACLE[f"stored_{stored}"] = ORACLE[plain]
