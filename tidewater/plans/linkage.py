"""Containment and fuzzy joins, and the threshold sweep."""

from pyspark.sql import functions as F

from tidewater.operators import metrics as M
from tidewater.operators import similarity as Y
from tidewater.plans.evaluation import rounded
from tidewater.plans.registry import query
from tidewater.session import spread, table


@query(
    "join_contains",
    """SELECT doc_id, item_id FROM documents d JOIN benchmark b
       ON contains(d.text, b.text) AND contains(d.text, split_part(b.text, '. ', 1))""",
)
def join_contains(spark, d):
    passages = table(spark, d, "benchmark").withColumn("head", F.substring_index("text", ". ", 1))
    return Y.join_contains(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", passages, "item_id", ["text", "head"])


@query(
    "join_contains_names",
    """SELECT c_custkey, n_nationkey FROM (SELECT c_custkey, c_mktsegment || ' of NATION_' || c_nationkey || ' / ' || c_name AS title
       FROM customer) JOIN nation ON contains(title, n_name)""",
)
def join_contains_names(spark, d):
    title = F.concat("c_mktsegment", F.lit(" of NATION_"), F.col("c_nationkey").cast("string"), F.lit(" / "), "c_name")
    titles = table(spark, d, "customer").select("c_custkey", title.alias("title"))
    return Y.join_contains(titles, "c_custkey", "title", table(spark, d, "nation"), "n_nationkey", ["n_name"])


NAME_SQL = "n AS (SELECT p_name || ' ' || p_brand AS s, count(*) AS c FROM part GROUP BY 1)"


def names(spark, d):
    return table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("name"), "p_type")


@query(
    "fuzzy_join_distance",
    f"""WITH {NAME_SQL} SELECT x.s AS a, y.s AS b, levenshtein(x.s, y.s)::INTEGER AS distance, x.c AS n_a, y.c AS n_b
        FROM n x JOIN n y ON x.s < y.s AND abs(length(x.s) - length(y.s)) < 3 WHERE levenshtein(x.s, y.s) < 3""",
)
def fuzzy_join_distance(spark, d):
    return Y.fuzzy_join_distance(names(spark, d), "name", 3)


# a row of bits per pair: bit i stays set while letter i of x is not yet matched
MASKS = """list_transform(string_split(y.s, ''), lambda c:
    list_sum(list_transform(range(length(x.s)), lambda i: CASE WHEN x.s[i + 1] = c THEN 1::BIGINT << i ELSE 0 END))::BIGINT)"""


@query(
    "fuzzy_join_ratio",
    f"""WITH {NAME_SQL}, p AS (SELECT x.s AS a, y.s AS b, x.c AS n_a, y.c AS n_b, (1::BIGINT << length(x.s)) - 1 AS f, {MASKS} AS m
          FROM n x JOIN n y ON x.s < y.s WHERE levenshtein(x.s, y.s) < 0.1 * (length(x.s) + length(y.s)) + 0.000001),
        r AS (SELECT *, list_reduce(list_prepend(f, m), lambda v, h: ((v + (v & h)) | (v - (v & h))) & ((1::BIGINT << length(a)) - 1)) AS v FROM p),
        t AS (SELECT *, 2 * (length(a) - bit_count(v)) / (length(a) + length(b)) AS ratio FROM r)
        SELECT a, b, round(ratio, 6) AS ratio, n_a, n_b FROM t WHERE ratio > 0.9""",
)
def fuzzy_join_ratio(spark, d):
    r = Y.fuzzy_join_ratio(names(spark, d), "name", 0.9)
    return r.withColumn("ratio", F.round("ratio", 6))


@query(
    "pr_curve",
    f"""WITH n AS (SELECT p_name || ' ' || p_brand AS s, p_type AS c, count(*) AS m FROM part GROUP BY 1, 2),
       s AS (SELECT s, sum(m) AS m FROM n GROUP BY 1),
       p AS (SELECT levenshtein(x.s, y.s) AS d, x.m * y.m AS pairs,
               (SELECT coalesce(sum(u.m * v.m), 0) FROM n u JOIN n v ON u.c = v.c WHERE u.s = x.s AND v.s = y.s) AS gold
             FROM s x JOIN s y ON x.s < y.s AND abs(length(x.s) - length(y.s)) < 4 WHERE levenshtein(x.s, y.s) < 4
             UNION ALL SELECT 0, m * (m - 1) / 2, (SELECT coalesce(sum(n.m * (n.m - 1) / 2), 0) FROM n WHERE n.s = s.s) FROM s),
       g AS (SELECT sum(k * (k - 1) / 2) AS total FROM (SELECT count(*) AS k FROM part GROUP BY p_type)),
       t AS (SELECT unnest([1.0, 2.0, 3.0, 4.0])::DOUBLE AS threshold)
       SELECT threshold, sum(pairs)::BIGINT AS kept, sum(gold)::BIGINT AS correct,
              round(sum(gold) / sum(pairs), 6) AS precision, round(sum(gold) / any_value(total), 6) AS recall
       FROM t JOIN p ON d < threshold, g GROUP BY 1""",
)
def pr_curve(spark, d):
    rows = names(spark, d)
    near = Y.fuzzy_join_distance(rows, "name", 4)
    counts = Y.pairs_by_score(rows, "name", "p_type", near, "distance")
    total = Y.gold_total(rows, "p_type")
    return rounded(M.threshold_curve(counts, "distance", "gold", "pairs", total, [1.0, 2.0, 3.0, 4.0], below=True))
