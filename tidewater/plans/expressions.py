"""Projections, filters and scalar functions over the given tables."""

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.operators import relational as R
from tidewater.operators.relational import small
from tidewater.plans.registry import query
from tidewater.session import table

# ---------------------------------------------------------------- projections


@query("select_trim", "SELECT c_custkey AS id, trim('  ' || c_name || ' ') AS name FROM customer")
def select_trim(spark, d):
    padded = F.concat(F.lit("  "), "c_name", F.lit(" "))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.trim(padded).alias("name"))


@query(
    "reshape_flatten",
    "SELECT o_custkey AS k, o_orderkey AS v1, round(o_totalprice, 2) AS v2 FROM orders",
)
def reshape_flatten(spark, d):
    pairs = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k0"), F.struct("o_custkey", "o_totalprice").alias("v0")
    )
    return pairs.select(
        F.col("v0.o_custkey").alias("k"),
        F.col("k0").alias("v1"),
        F.round("v0.o_totalprice", 2).alias("v2"),
    )


@query(
    "computed_concat",
    "SELECT p_partkey, cast(p_size AS VARCHAR) || ' + ' || p_brand AS label FROM part",
)
def computed_concat(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.concat_ws(" + ", F.col("p_size").cast("string"), "p_brand").alias("label")
    )


@query(
    "sentinel_to_null",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS size FROM events""",
)
def sentinel_to_null(spark, d):
    raw = F.when(F.col("event_type") == "error", F.lit("-")).otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", S.sentinel_to_null(raw, "-", "double").alias("size"))


@query(
    "cast_or_neg",
    """SELECT o_orderkey, coalesce(try_cast(substr(o_orderpriority, 1, 1) AS INTEGER), -1) AS rank,
       coalesce(try_cast(o_orderpriority AS INTEGER), -1) AS whole FROM orders""",
)
def cast_or_neg(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        S.cast_or(F.substring("o_orderpriority", 1, 1), "int", -1).alias("rank"),
        S.cast_or(F.col("o_orderpriority"), "int", -1).alias("whole"),
    )


@query(
    "route_mixed_types",
    """SELECT c_custkey, cast(c_nationkey AS DOUBLE) AS num1, c_acctbal AS num2,
       c_name || '|' || c_mktsegment AS cats FROM customer""",
)
def route_mixed_types(spark, d):
    cells = F.array(
        F.col("c_name"), F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string"), F.col("c_mktsegment")
    )
    row = table(spark, d, "customer").select("c_custkey", cells.alias("cells"))
    return row.select(
        "c_custkey",
        F.get(S.numeric_parts(F.col("cells")), F.lit(0)).alias("num1"),
        F.get(S.numeric_parts(F.col("cells")), F.lit(1)).alias("num2"),
        F.concat_ws("|", S.text_parts(F.col("cells"))).alias("cats"),
    )


@query(
    "feature_select",
    "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag AS label FROM lineitem",
)
def feature_select(spark, d):
    df = table(spark, d, "lineitem")
    # numeric features by type, keys and the label column left out
    feats = [c for c, t in df.dtypes if t == "double"]
    return df.select(*feats, F.col("l_returnflag").alias("label"))


@query(
    "assemble_vector",
    """SELECT p_partkey, p_size + p_retailprice AS total, 2 AS width, p_retailprice AS label FROM part""",
)
def assemble_vector(spark, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    made = VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="features").transform(
        table(spark, d, "part")
    )
    arr = vector_to_array("features")
    return made.select(
        "p_partkey",
        F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.size(arr).alias("width"),
        F.col("p_retailprice").alias("label"),
    )


# -------------------------------------------------------------------- filters


@query(
    "filter_not_contains",
    "SELECT p_partkey, p_name FROM part WHERE NOT contains(p_name, 'widget')",
)
def filter_not_contains(spark, d):
    return table(spark, d, "part").filter(~F.contains("p_name", F.lit("widget"))).select("p_partkey", "p_name")


@query(
    "drop_missing",
    """SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders
       WHERE o_orderstatus <> 'P' AND o_orderpriority <> '4-NOT SPECIFIED'""",
)
def drop_missing(spark, d):
    marked = table(spark, d, "orders").select(
        "o_orderkey",
        F.round("o_totalprice", 2).alias("price"),
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
    )
    return R.drop_missing(marked, ["status", "priority"]).select("o_orderkey", "price")


@query("filter_suffix", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%03'")
def filter_suffix(spark, d):
    return table(spark, d, "customer").filter(F.endswith("c_name", F.lit("03"))).select("c_custkey", "c_name")


@query(
    "filter_eq_ne",
    """SELECT event_id, user_id, event_type FROM events
       WHERE event_type = 'click' OR nullif(event_type, 'view') IS DISTINCT FROM 'error'""",
)
def filter_eq_ne(spark, d):
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    # a null is unequal to any value here, so the null-safe form is used
    keep = (F.col("event_type") == "click") | ~kind.eqNullSafe("error")
    return table(spark, d, "events").filter(keep).select("event_id", "user_id", "event_type")


@query(
    "filter_range",
    "SELECT o_orderkey, year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
)
def filter_range(spark, d):
    # bounds on the stored column, so row groups can be skipped
    date = F.col("o_orderdate")
    lo, hi = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1999-01-01").cast("timestamp_ntz")
    return table(spark, d, "orders").filter((date >= lo) & (date < hi)).select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("y")
    )


@query(
    "filter_modulo",
    "SELECT c_custkey FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 1000 <> 0",
)
def filter_modulo(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").filter((k % 2 == 1) & (k % 1000 != 0)).select("c_custkey")


@query(
    "filter_semi",
    """SELECT o_orderkey FROM orders WHERE o_custkey IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 0)""",
)
def filter_semi(spark, d):
    chosen = (
        table(spark, d, "customer")
        .filter((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 0))
        .select(F.col("c_custkey").alias("o_custkey"))
    )
    return table(spark, d, "orders").join(chosen, "o_custkey", "left_semi").select("o_orderkey")


@query(
    "filter_regex",
    r"""SELECT p_partkey, p_name, p_brand FROM part
        WHERE regexp_matches(p_name, '^(red|old) ') AND regexp_matches(p_brand, '1[0-9]*$')""",
)
def filter_regex(spark, d):
    return (
        table(spark, d, "part")
        .filter(F.col("p_name").rlike("^(red|old) ") & F.col("p_brand").rlike("1[0-9]*$"))
        .select("p_partkey", "p_name", "p_brand")
    )


@query(
    "filter_flatmap",
    "SELECT s_suppkey, round(s_acctbal * 2, 2) AS doubled FROM supplier WHERE s_acctbal > 0",
)
def filter_flatmap(spark, d):
    return (
        table(spark, d, "supplier")
        .filter(F.col("s_acctbal") > 0)
        .select("s_suppkey", F.round(F.col("s_acctbal") * 2, 2).alias("doubled"))
    )


@query(
    "filter_track_lang",
    """SELECT doc_id FROM documents WHERE lang = 'en'
       AND regexp_matches(lower(text), 'thand|eron')""",
)
def filter_track_lang(spark, d):
    hit = F.lower("text").rlike("thand|eron")
    return table(spark, d, "documents").filter((F.col("lang") == "en") & hit).select("doc_id")


# ------------------------------------------------------------ scalar functions


@query(
    "str_split_index",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS code,
       nullif(split_part(o_orderpriority, '-', 2), '') AS name FROM orders""",
)
def str_split_index(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", S.part_at(p, "-", 0).alias("code"), S.part_at(p, "-", 1).alias("name")
    )


@query(
    "str_digits",
    r"""SELECT p_partkey, cast(regexp_replace(p_brand, '[^0-9]', '', 'g') AS INTEGER) AS brand_no,
        cast(regexp_replace(p_type, '[^0-9]', '', 'g') = '' AS BOOLEAN) AS type_has_none FROM part""",
)
def str_digits(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        S.digits_only(F.col("p_brand")).alias("brand_no"),
        S.digits_only(F.col("p_type")).isNull().alias("type_has_none"),
    )


@query(
    "str_before_delim",
    """SELECT p_partkey, p_name AS head, split_part(p_brand, '#', 1) AS maker FROM part""",
)
def str_before_delim(spark, d):
    decorated = F.concat("p_name", F.lit(" (Metropolitan Area)"))
    return table(spark, d, "part").select(
        "p_partkey", S.before(decorated, "(").alias("head"), S.before(F.col("p_brand"), "#").alias("maker")
    )


@query("str_clean", "SELECT p_partkey, replace(p_name, ' ', '') AS name FROM part")
def str_clean(spark, d):
    dirty = F.concat(F.lit('"'), F.translate("p_name", " ", "\u00a0"), F.lit('"'))
    return table(spark, d, "part").select("p_partkey", S.clean_cell(dirty).alias("name"))


@query(
    "explode_compound",
    """WITH c AS (SELECT p_partkey AS code, p_name || '-' || p_brand || '-' || p_name AS nm, p_type AS st FROM part)
       SELECT DISTINCT code, trim(unnest(string_split(nm, '-'))) AS name, st AS state FROM c""",
)
def explode_compound(spark, d):
    named = table(spark, d, "part").select(
        F.col("p_partkey").alias("code"),
        F.concat(F.concat_ws("-", "p_name", "p_brand", "p_name"), F.lit(", "), "p_type").alias("place"),
    )
    return R.explode_compound(named, "place")


LOG_LINE = (
    "cast(user_id AS VARCHAR) || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] \"GET /' "
    "|| event_type || ' HTTP/1.0\" 200 ' || cast(event_id AS VARCHAR)"
)


def log_lines(spark, d):
    """Access log lines in the space-separated form, built from events."""
    return table(spark, d, "events").select(
        "event_id",
        F.concat(
            F.col("user_id").cast("string"),
            F.lit(" - - ["),
            F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
            F.lit(' +0000] "GET /'),
            F.col("event_type"),
            F.lit(' HTTP/1.0" 200 '),
            F.col("event_id").cast("string"),
        ).alias("line"),
    )


@query(
    "str_log_normalise",
    f"""SELECT event_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        {LOG_LINE}, ':', ','), ' \\+0000\\]', '', 'g'), '\\[', ''), ' - -', ''), '\\s+', ',', 'g') AS line,
        regexp_replace({LOG_LINE}, '^.* \\+0000\\]', '') AS request FROM events""",
)
def str_log_normalise(spark, d):
    return log_lines(spark, d).select(
        "event_id",
        S.normalise_log_line(F.col("line")).alias("line"),
        F.regexp_replace("line", r"^.* \+0000\]", "").alias("request"),
    )


@query(
    "extract_links",
    """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS link FROM pages),
       m AS (SELECT page_id, link FROM l WHERE link <> '' AND NOT contains(link, ']') AND NOT contains(link, '|')
             AND NOT contains(link, chr(10)))
       SELECT page_id, link, count(*) AS n FROM m GROUP BY page_id, link""",
)
def extract_links(spark, d):
    # anchors rewritten as wiki links, plain and piped by turns, then extracted
    anchors = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">'), F.lit(1))
    sound = F.filter(anchors, lambda a: (a != "") & ~a.rlike(r"[\]|\n]"))
    wiki = F.transform(
        sound,
        lambda a, i: F.concat(F.lit("see [["), a, F.when(i % 2 == 0, "]] x ").otherwise("|shown]] y ")),
    )
    text = table(spark, d, "pages").select("page_id", F.array_join(wiki, "").alias("text"))
    found = text.select("page_id", F.explode(S.links_in(F.col("text"))).alias("link"))
    return found.groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query("str_page_key", "SELECT p_partkey, 'page_' || replace(p_name, ' ', '_') AS page FROM part")
def str_page_key(spark, d):
    return table(spark, d, "part").select("p_partkey", S.page_key("page_", F.col("p_name")).alias("page"))


@query(
    "pad_columns",
    """WITH s AS (SELECT p_partkey, string_split(p_name || ' ' || p_type || CASE WHEN p_size > 25 THEN ' big' ELSE '' END, ' ') AS w FROM part)
       SELECT p_partkey, coalesce(w[1], '') AS c0, coalesce(w[2], '') AS c1, coalesce(w[3], '') AS c2,
              coalesce(w[4], '') AS c3 FROM s""",
)
def pad_columns(spark, d):
    extra = F.when(F.col("p_size") > 25, " big").otherwise("")
    words = table(spark, d, "part").select(
        "p_partkey", F.split(F.concat("p_name", F.lit(" "), "p_type", extra), " ").alias("w")
    )
    width = words.agg(F.max(F.size("w"))).first()[0] or 0
    slots = [F.coalesce(F.get("w", F.lit(i)), F.lit("")).alias(f"c{i}") for i in range(width)]
    return words.select("p_partkey", *slots)


@query(
    "str_lower_contains",
    """SELECT doc_id, contains(lower(text), 'the') AS has_the, NOT contains(text, '-') AS no_hyphen FROM documents""",
)
def str_lower_contains(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.contains(F.lower("text"), F.lit("the")).alias("has_the"),
        (~F.contains("text", F.lit("-"))).alias("no_hyphen"),
    )


@query(
    "dt_parse",
    "SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS epoch_s FROM events",
)
def dt_parse(spark, d):
    ts = S.parse_log_time(F.date_format("ts", "dd/MMM/yyyy"), F.date_format("ts", "HH:mm:ss"))
    # the zone in which text is read cancels out against the one it is shown in
    shown = F.date_format(ts, "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz")
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, d, "events").select(
        "event_id", F.timestamp_diff("SECOND", origin, shown).alias("epoch_s")
    )


@query(
    "dt_hour",
    """SELECT event_id, hour(ts) AS h, cast(strftime(ts, '%H') AS BIGINT) AS h_prefix,
       cast(strftime(ts, '%H') AS BIGINT) AS h_split FROM events""",
)
def dt_hour(spark, d):
    text = F.date_format("ts", "HH:mm:ss")
    return table(spark, d, "events").select(
        "event_id",
        F.hour("ts").cast("bigint").alias("h"),
        F.substring(text, 1, 2).cast("bigint").alias("h_prefix"),
        S.part_at(text, ":", 0).cast("bigint").alias("h_split"),
    )


@query(
    "levenshtein_fn",
    """SELECT p_partkey, levenshtein(p_name, p_type) AS dist,
       CASE WHEN levenshtein(p_name, 'red widget') <= 4 THEN levenshtein(p_name, 'red widget') ELSE -1 END AS capped
       FROM part""",
)
def levenshtein_fn(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.levenshtein("p_name", "p_type").cast("bigint").alias("dist"),
        F.levenshtein("p_name", F.lit("red widget"), 4).cast("bigint").alias("capped"),
    )


@query(
    "scale_minmax",
    """WITH e AS (SELECT min(l_quantity) q0, max(l_quantity) q1, min(l_extendedprice) p0, max(l_extendedprice) p1,
                  min(l_discount) d0, max(l_discount) d1, min(l_tax) t0, max(l_tax) t1 FROM lineitem)
       SELECT l_orderkey, l_linenumber, round((l_quantity - q0) / (q1 - q0), 6) AS l_quantity,
              round((l_extendedprice - p0) / (p1 - p0), 6) AS l_extendedprice,
              round((l_discount - d0) / (d1 - d0), 6) AS l_discount, round((l_tax - t0) / (t1 - t0), 6) AS l_tax
       FROM lineitem, e""",
)
def scale_minmax(spark, d):
    from tidewater.functions.scaling import scale_minmax as scale

    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return scale(df, digits=6)


@query(
    "scale_zscore",
    """WITH e AS (SELECT avg(o_totalprice) m, stddev_samp(o_totalprice) s FROM orders)
       SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice FROM orders, e""",
)
def scale_zscore(spark, d):
    from tidewater.functions.scaling import scale_zscore as scale

    return scale(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), digits=6)


def _channel(shift: int, lo: int, hi: int) -> str:
    p, q = (lo >> shift) & 0xFF, (hi >> shift) & 0xFF
    return f"cast(floor({p} + ({q - p}) * f) AS BIGINT)"


def gradient_sql(x: str, stops, source: str, keep: str) -> str:
    """SQL twin of the gradient: channel arithmetic instead of bit operations."""
    arms = [f"WHEN {x} < {stops[0][0]} THEN {stops[0][1]}"]
    share = []
    for (lo, c0), (hi, c1) in zip(stops, stops[1:]):
        share.append(f"WHEN {x} < {hi} THEN ({x} - {lo}) / ({hi - lo!r})")
        mix = " + ".join(f"{_channel(s, c0, c1)} * {1 << s}" for s in (24, 16, 8, 0))
        arms.append(f"WHEN {x} < {hi} THEN {mix}")
    return f"""WITH g AS (SELECT {keep}, {x}, CASE {' '.join(share)} END AS f FROM {source})
        SELECT {keep}, lpad(lower(to_hex(cast(CASE {' '.join(arms)} ELSE {stops[-1][1]} END AS BIGINT))), 8, '0') AS argb
        FROM g"""


STOPS = [(10000.0, S.BLUE_ARGB), (250000.0, S.GREEN_ARGB), (450000.0, S.RED_ARGB)]


@query("color_gradient", gradient_sql("o_totalprice", STOPS, "orders", "o_orderkey"))
def color_gradient(spark, d):
    colour = S.colour_gradient(F.col("o_totalprice"), STOPS)
    return table(spark, d, "orders").select("o_orderkey", S.argb_hex(colour).alias("argb"))


@query(
    "linear_rescale",
    """WITH e AS (SELECT min(value) lo, max(value) hi FROM events)
       SELECT event_id, round(20 + (value - lo) * 760 / (hi - lo), 6) AS px,
              round(100 * value / 500, 6) AS px_fixed FROM events, e""",
)
def linear_rescale(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    lo, hi = ev.agg(F.min("value"), F.max("value")).first()
    return ev.select(
        "event_id",
        F.round(S.rescale(F.col("value"), F.lit(lo), F.lit(hi), 20.0, 780.0), 6).alias("px"),
        F.round(S.rescale(F.col("value"), F.lit(0.0), F.lit(500.0), 0.0, 100.0), 6).alias("px_fixed"),
    )


@query(
    "nice_ticks",
    """WITH e AS (SELECT event_type, min(value) lo, max(value) hi FROM events GROUP BY event_type),
       r AS (SELECT *, (hi - lo) / 6 AS raw FROM e),
       s AS (SELECT *, round(round(raw / pow(10, floor(log10(raw))), 1)) * pow(10, floor(log10(raw))) AS step FROM r)
       SELECT event_type, step AS spacing,
              round(unnest(generate_series(cast(ceil(round(lo / step, 9)) AS BIGINT),
                                           cast(floor(round(hi / step, 9)) AS BIGINT))) * step, 9) AS tick
       FROM s""",
)
def nice_ticks(spark, d):
    extent = table(spark, d, "events").groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    return extent.select(
        "event_type", S.tick_spacing(lo, hi).alias("spacing"), F.explode(S.nice_ticks(lo, hi)).alias("tick")
    )


@query(
    "rating_polarity",
    """WITH r AS (SELECT doc_id, doc_id % 6 AS scale, (doc_id // 6) % 11 AS s FROM documents)
       SELECT doc_id, CASE scale
         WHEN 0 THEN CASE WHEN s >= 7 THEN 'pos' WHEN s <= 4 THEN 'neg' END
         WHEN 1 THEN CASE WHEN s % 6 >= 4 THEN 'pos' WHEN s % 6 <= 2 THEN 'neg' END
         WHEN 2 THEN CASE WHEN s % 4 >= 2 THEN 'pos' WHEN s % 4 = 0 THEN 'neg' END
         WHEN 3 THEN CASE WHEN s % 5 = 0 OR s % 5 = 1 THEN 'pos' WHEN s % 5 >= 3 THEN 'neg' END
         WHEN 4 THEN CASE WHEN s * 0.5 >= 3.5 THEN 'pos' WHEN s * 0.5 <= 2 THEN 'neg' END
       END AS polarity FROM r""",
)
def rating_polarity(spark, d):
    # every text gets a stated rating in one of five forms, or none
    s = ((F.col("doc_id") - F.col("doc_id") % 6) / 6).cast("bigint") % 11
    words = F.array(*[F.lit(w) for w in ["zero", "one", "two", "three", "four", "five"]])
    grades = F.array(*[F.lit(g) for g in ["A", "B", "C+", "C-", "D"]])
    scale = F.col("doc_id") % 6
    note = (
        F.when(scale == 0, F.concat(s.cast("string"), F.lit("/10")))
        .when(scale == 1, F.concat(F.get(words, (s % 6).cast("int")), F.lit(" out of five")))
        .when(scale == 2, F.concat(F.lit("OUT OF ****: "), F.repeat(F.lit("*"), (s % 4 + 1).cast("int"))))
        .when(scale == 3, F.concat(F.lit("Grade: "), F.get(grades, (s % 5).cast("int"))))
        .when(scale == 4, F.concat((s * 0.5).cast("decimal(4,1)").cast("string"), F.lit(" out of 5")))
        .otherwise(F.lit("no rating"))
    )
    rated = F.concat(note, F.lit(" \n"), F.regexp_replace("text", r"[0-9*/]|(?i)grade", " "))
    rated = table(spark, d, "documents").select("doc_id", rated.alias("text"))
    return S.with_rating(rated, "text").select("doc_id", "polarity")


@query(
    "json_field",
    """SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
       WHERE json_extract_string(props, '$.k') IS NOT NULL""",
)
def json_field(spark, d):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, d, "events").select("event_id", k.alias("k")).filter(F.col("k").isNotNull())


# ------------------------------------------------------------------- lookups


@query(
    "src_literal_range",
    """WITH m AS (SELECT unnest(generate_series(1, 12)) AS month_no),
       names AS (SELECT * FROM (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('5-LOW', 1)) t(code, weight)),
       o AS (SELECT month(o_orderdate) AS month_no, count(*) AS n, sum(weight)::BIGINT AS weight
             FROM orders JOIN names ON o_orderpriority = code GROUP BY 1)
       SELECT m.month_no, coalesce(n, 0) AS n, coalesce(weight, 0) AS weight FROM m LEFT JOIN o USING (month_no)""",
)
def src_literal_range(spark, d):
    weights = spark.createDataFrame(
        [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("5-LOW", 1)], "o_orderpriority string, weight bigint"
    )
    months = spark.range(1, 13).withColumnRenamed("id", "month_no")
    per = (
        table(spark, d, "orders")
        .join(small(weights), "o_orderpriority")
        .groupBy(F.month("o_orderdate").cast("bigint").alias("month_no"))
        .agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    )
    return months.join(per, "month_no", "left").na.fill(0, ["n", "weight"])
