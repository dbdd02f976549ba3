"""Text operators over the whole documents."""

from pyspark.sql import functions as F

from tidewater.functions import words as X
from tidewater.plans.registry import query
from tidewater.session import spread, table

# Stop words used by the stop-word queries.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "by", "for", "in", "is", "it", "of", "on", "or", "that", "the", "to", "was", "with"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOKEN_SQL = r"regexp_extract_all(text, '[A-Za-z0-9'']+|[^\sA-Za-z0-9]')"
WORDS_SQL = "regexp_extract_all(lower(text), '[a-z]+')"


@query(
    "tokenize_words",
    f"""SELECT doc_id, len({TOKEN_SQL}) AS n_tokens, len(list_distinct({TOKEN_SQL})) AS n_distinct,
        {TOKEN_SQL}[1] AS first_token FROM documents""",
)
def tokenize_words(spark, d):
    toks = documents(spark, d).select("doc_id", X.tokens(F.col("text")).alias("t"))
    return toks.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"), F.get("t", F.lit(0)).alias("first_token"),
    )


@query(
    "tokenize_sentences",
    r"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])[ \t\r\n]+', '\1' || chr(1), 'g'), chr(1)),
                 lambda x: trim(x) <> '') AS s FROM documents)
        SELECT doc_id, len(s) AS n, s[1] AS first, s[len(s)] AS last FROM s""",
)
def tokenize_sentences(spark, d):
    s = documents(spark, d).select("doc_id", X.sentences(F.col("text")).alias("s"))
    return s.select(
        "doc_id", F.size("s").cast("bigint").alias("n"), F.get("s", F.lit(0)).alias("first"),
        F.try_element_at("s", F.lit(-1)).alias("last"),
    )


@query(
    "stopword_filter",
    f"""WITH t AS (SELECT doc_id, {TOKEN_SQL} AS t FROM documents)
        SELECT doc_id, len(list_filter(t, lambda x: lower(x) NOT IN ({STOP_SQL}))) AS n_kept,
               len(t) AS n_all FROM t""",
)
def stopword_filter(spark, d):
    toks = documents(spark, d).select("doc_id", X.tokens(F.col("text")).alias("t"))
    kept = X.drop_stop_words(F.col("t"), STOP_WORDS)
    return toks.select("doc_id", F.size(kept).cast("bigint").alias("n_kept"), F.size("t").cast("bigint").alias("n_all"))


def documents(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "lang", "text"))


def all_words(spark, d):
    return documents(spark, d).select("doc_id", "lang", F.explode(X.words(F.col("text"))).alias("word"))


@query("stem_tokens")
def stem_tokens(spark, d):
    # counted before the stems are looked up: the join sees a row per word
    counts = all_words(spark, d).groupBy("word").agg(F.count("*").alias("n"))
    stems = counts.withColumn("stem", X.stem(F.col("word")))
    return stems.groupBy("stem").agg(F.sum("n").alias("n"), F.count("*").alias("n_forms"))


@query(
    "lemma_lookup",
    """WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
       lex(word, lemma) AS (VALUES ('was', 'be'), ('is', 'be'), ('are', 'be'), ('eines', 'ein'), ('the', 'the')),
       c AS (SELECT word, count(*) AS n FROM w GROUP BY 1)
       SELECT coalesce(lemma, c.word) AS lemma, sum(n)::BIGINT AS n FROM c LEFT JOIN lex ON lex.word = c.word GROUP BY 1""",
)
def lemma_lookup(spark, d):
    lex = spark.createDataFrame(
        [("was", "v", "be"), ("is", "v", "be"), ("are", "v", "be"), ("eines", "v", "ein"), ("the", "v", "the")],
        "word string, pos string, lemma string",
    )
    counts = all_words(spark, d).groupBy("word").agg(F.count("*").alias("n")).withColumn("pos", F.lit("v"))
    found = X.lexicon_lookup(counts, lex, ["word", "pos"], "lemma", F.col("word"))
    return found.groupBy("lemma").agg(F.sum("n").alias("n"))


@query(
    "tag_filter",
    """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
       lex(word, tag) AS (VALUES ('was', 'VBD'), ('is', 'VBZ'), ('the', 'DT'), ('of', 'IN'), ('red', 'JJ'), ('are', 'VBP'))
       SELECT doc_id, w.word, tag, count(*) AS n FROM w JOIN lex ON lex.word = w.word
       WHERE tag LIKE 'J%' OR tag LIKE 'V%' GROUP BY 1, 2, 3""",
)
def tag_filter(spark, d):
    counts = all_words(spark, d).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    kept = lexicon(spark).filter(F.substring("tag", 1, 1).isin("J", "V"))
    return counts.join(X.small(kept), "word").select("doc_id", "word", "tag", "n")


def lexicon(spark):
    rows = [("was", "VBD"), ("is", "VBZ"), ("the", "DT"), ("of", "IN"), ("red", "JJ"), ("are", "VBP")]
    return spark.createDataFrame(rows, "word string, tag string")


@query(
    "tag_chunks",
    rf"""WITH t AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[A-Za-z]+'), lambda w: CASE
           WHEN lower(w) IN ('was', 'is', 'are') THEN '<VBZ>' WHEN lower(w) IN ('of', 'in', 'by', 'on', 'with') THEN '<IN>'
           WHEN lower(w) IN ('the', 'a', 'an') THEN '<DT>' WHEN regexp_matches(w, '^[A-Z]') THEN '<NNP>'
           WHEN regexp_matches(w, 'ly$') THEN '<RB>' ELSE '<NN>' END), '') AS tags FROM documents)
        SELECT doc_id, len(regexp_extract_all(tags, '((?:<RB.?>)*(?:<VB.?>)*(?:<NNP>)+(?:<NN>)?)')) AS n_chunks,
               len(list_filter(string_split_regex(tags, '(?:<VB.?.?>|<IN>|<DT>)+'), lambda x: x <> '')) AS n_chinked FROM t""",
)
def tag_chunks(spark, d):
    def tag(w):
        low = F.lower(w)
        return (
            F.when(low.isin("was", "is", "are"), "<VBZ>")
            .when(low.isin("of", "in", "by", "on", "with"), "<IN>")
            .when(low.isin("the", "a", "an"), "<DT>")
            .when(w.rlike("^[A-Z]"), "<NNP>")
            .when(w.rlike("ly$"), "<RB>")
            .otherwise("<NN>")
        )

    found = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    tagged = documents(spark, d).select("doc_id", F.array_join(F.transform(found, tag), "").alias("tags"))
    return tagged.select(
        "doc_id",
        F.size(X.tag_chunks(F.col("tags"))).cast("bigint").alias("n_chunks"),
        F.size(X.tag_chinks(F.col("tags"))).cast("bigint").alias("n_chinked"),
    )


@query(
    "corpus_freq",
    f"""SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest({WORDS_SQL}) AS word FROM documents) GROUP BY 1, 2""",
)
def corpus_freq(spark, d):
    return all_words(spark, d).groupBy("lang", "word").agg(F.count("*").alias("n"))


@query(
    "vocab_top_n",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS word FROM documents) GROUP BY 1
        ORDER BY n DESC, word LIMIT 5000""",
)
def vocab_top_n(spark, d):
    docs = documents(spark, d).select(X.words(F.col("text")).alias("w"))
    return X.vocabulary(docs, "w", 5000)


@query(
    "bow_presence",
    f"""WITH w AS (SELECT doc_id, unnest({WORDS_SQL}) AS word FROM documents),
        v AS (SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 5000)
        SELECT DISTINCT doc_id, w.word FROM w JOIN v ON v.word = w.word""",
)
def bow_presence(spark, d):
    docs = documents(spark, d).select("doc_id", X.words(F.col("text")).alias("w"))
    return X.presence(docs, ["doc_id"], "w", X.vocabulary(docs, "w", 5000)).select("doc_id", "word")
