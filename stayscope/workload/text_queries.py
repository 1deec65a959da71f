"""Text operators on documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayscope.functions import text as tx
from stayscope.operators import notes as nt
from stayscope.operators import topics
from stayscope.plans import study
from stayscope.sources.scan import spread_scan
from stayscope.storage import materialise, new_path
from stayscope.workload import roles
from stayscope.workload.registry import query

# Frequent words of the four languages of the documents.
STOP_WORDS = """
    a about after all an and are as at be by for from has in is it its not of on or that the
    this to was with de des du en la le les que un une der die das ist nicht und von zu con del
    el los las por para Patient NOTE
""".split()

# The default English stop words, as the SQL twin needs them.
ENGLISH = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
    her hers herself it its itself they them their theirs themselves what which who whom this that
    these those am is are was were be been being have has had having do does did doing a an the and
    but if or because as until while of at by for with about against between into through during
    before after above below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
    i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
    shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
    what's when's where's who's why's would
""".split()


def documents(spark, sf_dir):
    docs = roles.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return spread_scan(docs, "id")


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# The same passes for RE2, which has no look-behind.
_PUNCTUATION_SQL = r"""[ !"#$%&''()*+,\-./:;<=>?@\[\\\]^_`{}~−]"""


def _clean_sql(text: str) -> str:
    for pattern in (_PUNCTUATION_SQL, r"\w*\d\w*", tx.LONE_LETTER, tx.LONE_LETTER):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return text


_WORDS_SQL = f"""
words AS (
  SELECT id, word FROM (
    SELECT doc_id AS id,
           unnest(regexp_split_to_array(lower({_clean_sql("text")}), '\\s+')) AS word
    FROM documents) WHERE length(word) >= 1),
kept AS (SELECT * FROM words WHERE word NOT IN ({_sql_list(w.lower() for w in STOP_WORDS)})),
counts AS (SELECT id, word AS term, count(*) AS n FROM kept GROUP BY id, word)"""

_VOCABULARY_SQL = f"""{_WORDS_SQL},
ranked AS (
  SELECT term, CAST(sum(n) AS BIGINT) AS total, count(*) AS documents,
         row_number() OVER (ORDER BY sum(n) DESC, term) - 1 AS idx
  FROM counts GROUP BY term),
vocab AS (SELECT * FROM ranked)"""


def counts(spark, sf_dir):
    return nt.term_counts(documents(spark, sf_dir), stop_words=STOP_WORDS)


@query(
    "clean_text",
    f"SELECT doc_id, md5({_clean_sql('text')}) AS cleaned_md5 FROM documents",
)
def clean_text(spark, sf_dir):
    cleaned = F.md5(tx.clean_text(F.col("text"))).alias("cleaned_md5")
    return documents(spark, sf_dir).select(F.col("id").alias("doc_id"), cleaned)


@query(
    "stopword_default",
    f"""WITH {_WORDS_SQL}
    SELECT word AS term, count(*) AS n, count(DISTINCT id) AS documents FROM words
    WHERE word NOT IN ({_sql_list({w.lower() for w in (*ENGLISH, *STOP_WORDS)})}) GROUP BY word""",
)
def stopword_default(spark, sf_dir):
    """Terms that the default English list and a file of further words leave."""
    path = new_path(spark, "words")
    lines = spark.createDataFrame([(",".join(STOP_WORDS[i : i + 7]),) for i in range(0, len(STOP_WORDS), 7)], "value string")
    lines.write.text(path)
    terms = nt.term_counts(documents(spark, sf_dir), stop_words=study.stop_words_with(spark, path))
    return terms.groupBy("term").agg(F.sum("n").alias("n"), F.count("*").alias("documents"))


@query(
    "tokenize_docs",
    f"WITH {_WORDS_SQL} SELECT id, count(*) AS n_tokens, count(DISTINCT word) AS n_terms FROM words GROUP BY id",
)
def tokenize_docs(spark, sf_dir):
    words = F.array_distinct("words")
    split = documents(spark, sf_dir).select("id", tx.tokens(tx.clean_text(F.col("text"))).alias("words"))
    return split.filter(F.size("words") > 0).select(
        "id",
        F.size("words").cast("long").alias("n_tokens"),
        F.size(words).cast("long").alias("n_terms"),
    )


@query(
    "stopword_filter",
    f"""WITH {_WORDS_SQL}
    SELECT w.id, w.n - coalesce(k.n, 0) AS n_dropped, coalesce(k.n, 0) AS n_kept
    FROM (SELECT id, count(*) AS n FROM words GROUP BY id) w
    LEFT JOIN (SELECT id, count(*) AS n FROM kept GROUP BY id) k ON w.id = k.id""",
)
def stopword_filter(spark, sf_dir):
    split = documents(spark, sf_dir).select("id", tx.tokens(tx.clean_text(F.col("text"))).alias("words"))
    both = split.withColumn("kept", tx.without_stop_words(F.col("words"), STOP_WORDS))
    return both.filter(F.size("words") > 0).select(
        "id",
        (F.size("words") - F.size("kept")).cast("long").alias("n_dropped"),
        F.size("kept").cast("long").alias("n_kept"),
    )


@query("term_counts", f"WITH {_WORDS_SQL} SELECT id, term, n FROM counts")
def term_counts(spark, sf_dir):
    return counts(spark, sf_dir)


@query(
    "corpus_stats",
    f"""WITH {_WORDS_SQL}
    SELECT count(DISTINCT id) AS n_documents, count(*) AS n_pairs, CAST(sum(n) AS BIGINT) AS n_tokens
    FROM counts""",
)
def corpus_stats(spark, sf_dir):
    return nt.corpus_stats(counts(spark, sf_dir))


@query("vocabulary", f"WITH {_VOCABULARY_SQL} SELECT term, total, documents, idx FROM vocab")
def vocabulary(spark, sf_dir):
    return nt.vocabulary(counts(spark, sf_dir))


@query(
    "note_vectors",
    f"""WITH {_VOCABULARY_SQL}
    SELECT c.id, CAST(v.idx AS INT) AS idx, CAST(c.n AS DOUBLE) AS value
    FROM counts c JOIN vocab v ON c.term = v.term""",
)
def note_vectors(spark, sf_dir):
    found = materialise(counts(spark, sf_dir), "terms")
    vocab = nt.vocabulary(found)
    rows = nt.sparse_rows(nt.index_terms(found, vocab), vocab.count())
    pairs = F.arrays_zip("features.indices", "features.values")
    return rows.select("id", F.explode(pairs).alias("_e")).select(
        "id", F.col("_e.indices").alias("idx"), F.col("_e.values").alias("value")
    )


@query(
    "concat_notes",
    """SELECT conv_id AS id,
      row_number() OVER w - 1 AS position,
      CAST(coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS BIGINT) AS start_char,
      md5(text) AS text_md5
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def concat_notes(spark, sf_dir):
    joined = nt.concat_notes(roles.notes(spark, sf_dir), ["turn"])
    return joined.select("id", "position", "start_char", F.md5("text").alias("text_md5"))


def _topic_model(spark, sf_dir):
    """The full model of all notes, by the same rounds over edges as the study's."""
    return topics.fit_topics(nt.term_counts(roles.notes(spark, sf_dir), stop_words=STOP_WORDS, inner=True))


@query("note_topics")
def note_topics(spark, sf_dir):
    rows = topics.topic_tuples(_topic_model(spark, sf_dir))
    return rows.select(F.col("id").cast("long").alias("id"), "feature", "value")


@query("topic_terms")
def topic_terms(spark, sf_dir):
    """The strongest terms of each topic, by their share of the topic's tokens."""
    best = topics.topic_terms(_topic_model(spark, sf_dir), share=True)
    return best.select("topic", "rank", "term", "weight")


#: Small enough for a twin that spells every round out.
_FEW_TOPICS, _FEW_ROUNDS = 4, 3


def topics_sql(k: int, rounds: int) -> str:
    """Rounds of expectation maximisation over ``edges(corpus, id, term, n)``, one table expression after another.

    ``d<rounds>`` and ``t<rounds>`` hold the final weights of documents and terms.
    """
    first = f"""
        size AS MATERIALIZED (SELECT corpus, count(DISTINCT term) AS n_terms FROM edges GROUP BY corpus),
        g0 AS MATERIALIZED (
          SELECT corpus, id, term, topic, n, n * w / sum(w) OVER (PARTITION BY corpus, id, term) AS g FROM (
          SELECT corpus, id, term, topic, n, CAST(('0x' || substr(md5('{topics.SEED}:' || CAST(id AS VARCHAR) || ':'
            || term || ':' || CAST(topic AS VARCHAR)), 1, 8)) AS BIGINT) % {topics.STEPS} + 1 AS w
          FROM (SELECT *, unnest(range({k})) AS topic FROM edges)))"""
    parts = [first]
    for r in range(rounds + 1):
        parts.append(
            f"""d{r} AS MATERIALIZED (SELECT corpus, id, topic, sum(g) AS w FROM g{r} GROUP BY corpus, id, topic),
            t{r} AS MATERIALIZED (SELECT corpus, term, topic, sum(g) AS w FROM g{r} GROUP BY corpus, term, topic),
            s{r} AS MATERIALIZED (SELECT corpus, topic, sum(g) AS w, max(n_terms) AS n_terms
              FROM g{r} JOIN size USING (corpus) GROUP BY corpus, topic)"""
        )
        if r < rounds:
            parts.append(
                f"""g{r + 1} AS MATERIALIZED (
                SELECT corpus, id, term, topic, n, n * w / sum(w) OVER (PARTITION BY corpus, id, term) AS g FROM (
                  SELECT g.corpus, g.id, g.term, g.topic, g.n,
                    (d.w + {topics.DOCUMENT_PRIOR / k}) * (t.w + {topics.TERM_PRIOR})
                    / (s.w + s.n_terms * {topics.TERM_PRIOR}) AS w
                  FROM g{r} g JOIN d{r} d ON g.corpus = d.corpus AND g.id = d.id AND g.topic = d.topic
                  JOIN t{r} t ON g.corpus = t.corpus AND g.term = t.term AND g.topic = t.topic
                  JOIN s{r} s ON g.corpus = s.corpus AND g.topic = s.topic))"""
            )
    return ",\n".join(parts)


_TOPICS_SQL = f"""{_WORDS_SQL},
edges AS (SELECT '' AS corpus, * FROM counts),{topics_sql(_FEW_TOPICS, _FEW_ROUNDS)}"""


def _full_topics_sql(k: int, rounds: int) -> str:
    """The rounds of :func:`topics_sql` over ``counts(id, term, n)``, short enough for the full model.

    Weights are lists, and an edge keeps one number: its count over the product of its document's and term's weights.
    """

    def each(form: str) -> str:
        return "[" + ", ".join(form.format(i=i) for i in range(1, k + 1)) + "]"

    by_document, by_term = (f"[x + {p} FOR x IN w]" for p in (topics.DOCUMENT_PRIOR / k, topics.TERM_PRIOR))
    parts = [
        f"""
        size AS MATERIALIZED (SELECT count(DISTINCT term) AS n_terms FROM counts),
        g0 AS MATERIALIZED (
          SELECT id, term, n / list_sum(h) AS p, h FROM (
            SELECT id, term, n, [CAST(CAST(('0x' || substr(md5('{topics.SEED}:'
              || CAST(id AS VARCHAR) || ':' || term || ':' || CAST(i AS VARCHAR)), 1, 8)) AS BIGINT)
              % {topics.STEPS} + 1 AS DOUBLE) FOR i IN range({k})] AS h FROM counts)),
        d0 AS MATERIALIZED (SELECT id, {each("sum(p * h[{i}])")} AS w FROM g0 GROUP BY id),
        t0 AS MATERIALIZED (SELECT term, {each("sum(p * h[{i}])")} AS w FROM g0 GROUP BY term)"""
    ]
    for r in range(rounds):
        parts.append(
            f"""s{r} AS MATERIALIZED (SELECT {each("sum(w[{i}])")} AS w FROM t{r}),
            a{r} AS MATERIALIZED (SELECT id, {by_document} AS a FROM d{r}),
            b{r} AS MATERIALIZED (
              SELECT term, [x[1] / (x[2] + n_terms * {topics.TERM_PRIOR}) FOR x IN list_zip(w, s)] AS b
              FROM (SELECT term, {by_term} AS w FROM t{r}), (SELECT w AS s FROM s{r}), size),
            g{r + 1} AS MATERIALIZED (
              SELECT id, term, n / list_dot_product(a, b) AS p
              FROM counts JOIN a{r} USING (id) JOIN b{r} USING (term)),
            d{r + 1} AS MATERIALIZED (
              SELECT id, {each("any_value(a[{i}]) * sum(p * b[{i}])")} AS w
              FROM g{r + 1} JOIN a{r} USING (id) JOIN b{r} USING (term) GROUP BY id),
            t{r + 1} AS MATERIALIZED (
              SELECT term, {each("any_value(b[{i}]) * sum(p * a[{i}])")} AS w
              FROM g{r + 1} JOIN a{r} USING (id) JOIN b{r} USING (term) GROUP BY term)"""
        )
    return ",\n".join(parts)


def note_words_sql(stop_words) -> str:
    """``note_words(id, ts, term)``: the tokens of all notes and when they were written."""
    text = _clean_sql("' ' || text || ' '")
    return f"""
note_words AS (
  SELECT * FROM (
    SELECT conv_id AS id, TIMESTAMP '2024-01-01 00:00:00' + turn * INTERVAL 1 HOUR AS ts,
      unnest(regexp_split_to_array(lower({text}), '\\s+')) AS term
    FROM conversations)
  WHERE length(term) >= 1 AND term NOT IN ({_sql_list(sorted({w.lower() for w in stop_words}))}))"""


def _few_topics(spark, sf_dir):
    return topics.fit_topics(counts(spark, sf_dir), _FEW_TOPICS, _FEW_ROUNDS)


@query(
    "topic_shares",
    f"""WITH {_WORDS_SQL},{_full_topics_sql(topics.TOPICS, topics.ROUNDS)}
    SELECT CAST(id AS VARCHAR) AS id, 'topic-' || CAST(topic AS VARCHAR) AS feature,
      round(w[topic + 1] / list_sum(w), 6) AS value
    FROM (SELECT id, w, unnest(range({topics.TOPICS})) AS topic FROM d{topics.ROUNDS})""",
)
def topic_shares(spark, sf_dir):
    """Share of each topic of the full model in each document, by expectation maximisation over edges."""
    rows = topics.topic_tuples(topics.fit_topics(counts(spark, sf_dir)))
    return rows.select("id", "feature", F.round("value", 6).alias("value"))


@query(
    "topic_term_weights",
    f"""WITH {_TOPICS_SQL}
    SELECT term, CAST(topic AS INT) AS topic, round(w, 5) AS weight FROM t{_FEW_ROUNDS}""",
)
def topic_term_weights(spark, sf_dir):
    """Weight of each term in each topic, by the same model."""
    spread = _few_topics(spark, sf_dir).terms.select("term", F.posexplode("w").alias("topic", "weight"))
    return spread.select("term", "topic", F.round("weight", 5).alias("weight"))


@query(
    "topic_mass",
    f"""WITH words AS (
      SELECT id, word FROM (
        SELECT conv_id AS id,
          unnest(regexp_split_to_array(lower({_clean_sql("' ' || text || ' '")}), '\\s+')) AS word
        FROM conversations) WHERE length(word) >= 1)
    SELECT CAST(id AS VARCHAR) AS id, CAST({topics.TOPICS} AS INT) AS n_topics,
      CAST(count(*) AS DOUBLE) AS tokens FROM words
    WHERE word NOT IN ({_sql_list(w.lower() for w in STOP_WORDS)}) GROUP BY id""",
)
def topic_mass(spark, sf_dir):
    """Tokens of all notes as the topics of the full model share them out: none is lost or doubled."""
    total = F.aggregate("w", F.lit(0.0), lambda a, b: a + b)
    return _topic_model(spark, sf_dir).documents.select(
        "id", F.size("w").alias("n_topics"), F.round(total, 3).alias("tokens")
    )
