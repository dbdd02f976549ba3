"""Sources and sinks.

Each query first lays a given table out in the wanted file form, under the
shared folder, and then reads it back through the source under test.
"""

from pyspark.sql import functions as F

from tidewater.functions import scalars as S
from tidewater.plans.registry import query
from tidewater.session import scratch_path, table
from tidewater.sources import markup, text


def staged_text(df, label):
    path = scratch_path(df.sparkSession, label)
    df.write.text(path)
    return path


@query(
    "src_tsv_typed",
    """SELECT 'LA' || o_custkey || '03' AS id, cast(year(o_orderdate) AS INTEGER) AS year,
              cast(month(o_orderdate) AS INTEGER) AS month, o_totalprice AS value
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def src_tsv_typed(spark, d):
    value = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_totalprice").cast("string"))
    lines = table(spark, d, "orders").select(
        F.concat_ws(
            "\t",
            F.concat(F.lit("LA"), F.col("o_custkey").cast("string"), F.lit("03 ")),
            F.year("o_orderdate").cast("string"),
            F.date_format("o_orderdate", "'M'MM"),
            F.concat(F.lit(" "), value),
        )
    )
    header = spark.createDataFrame([("series_id\tyear\tperiod\tvalue",)], "value string")
    path = staged_text(lines.union(header), "tsv")
    fields = {"id": (0, "string"), "year": (1, "int"), "period": (2, "string"), "value": (3, "double")}
    rows = text.typed_lines(spark, path, fields, header="series_id", drop_if_contains="-")
    return rows.filter(F.endswith("id", F.lit("03"))).select(
        "id", "year", S.digits_only(F.col("period")).alias("month"), "value"
    )


@query(
    "src_quoted_csv",
    "SELECT cast(p_partkey AS VARCHAR) AS geo_id, p_name || ', ' || p_type AS geo_name, p_size AS code, p_retailprice AS v FROM part WHERE p_size <> 1",
)
def src_quoted_csv(spark, d):
    part = table(spark, d, "part")
    path = staged_text(
        part.select(
            F.concat(
                F.lit('"'), F.col("p_partkey").cast("string"), F.lit('", "'), "p_name", F.lit(", "), "p_type",
                F.lit('",'), F.col("p_size").cast("string"), F.lit(", "), F.col("p_retailprice").cast("string"),
            )
        ),
        "quoted",
    )
    rows = text.delimited(spark, path, "geo_id string, geo_name string, code int, v double")
    return rows.filter(F.col("code") != 1)


@query(
    "src_csv_drop_blank",
    """SELECT cast(c_custkey AS VARCHAR) AS zip, c_acctbal AS lat, cast(c_nationkey AS DOUBLE) AS lon, c_mktsegment AS city
       FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 3""",
)
def src_csv_drop_blank(spark, d):
    lat = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("")
    lon = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string")).otherwise("")
    rows = table(spark, d, "customer").select(
        F.concat_ws(",", F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('"')), lat, lon, "c_mktsegment")
    )
    got = text.delimited(spark, staged_text(rows, "zip"), "zip string, lat double, lon double, city string")
    return got.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def _roundtrip(spark, df, header=True, encoding="UTF-8", sep=","):
    path = scratch_path(spark, "csv")
    df.write.option("header", header).option("encoding", encoding).option("sep", sep).option("escape", '"').csv(path)
    return path


@query(
    "src_csv_schema",
    "SELECT o_custkey AS id, cast(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS period, o_totalprice AS value FROM orders",
)
def src_csv_schema(spark, d):
    df = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("period"), F.col("o_totalprice").alias("value"),
    )
    return text.delimited(spark, _roundtrip(spark, df, sep="\t"), "id bigint, year int, period string, value double", True, "\t")


@query(
    "src_text_lines",
    """WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
       SELECT length(line) AS width, count(*) AS n, count(DISTINCT line) AS n_distinct FROM l GROUP BY 1""",
)
def src_text_lines(spark, d):
    path = staged_text(table(spark, d, "documents").select("text"), "lines")
    lines = text.text_lines(spark, path)
    return lines.groupBy(F.length("value").cast("bigint").alias("width")).agg(
        F.count("*").alias("n"), F.countDistinct("value").alias("n_distinct")
    )


@query(
    "src_weblog_csv",
    """SELECT user_id, strftime(ts, '%d/%b/%Y') AS date, strftime(ts, '%H:%M:%S') AS time, '/é/' || event_type AS url,
              CASE WHEN event_type = 'error' THEN NULL ELSE value END AS size FROM events""",
)
def src_weblog_csv(spark, d):
    df = table(spark, d, "events").select(
        "user_id",
        F.date_format("ts", "dd/MMM/yyyy").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.concat(F.lit("/é/"), "event_type").alias("url"),
        F.when(F.col("event_type") == "error", "-").otherwise(F.col("value").cast("string")).alias("size"),
    )
    path = _roundtrip(spark, df, header=False, encoding="ISO-8859-1")
    got = text.delimited(spark, path, "user_id bigint, date string, time string, url string, size string", encoding="ISO-8859-1")
    return got.withColumn("size", S.sentinel_to_null(F.col("size"), "-", "double"))


@query("src_csv_header", "SELECT p_partkey AS id, p_brand AS cluster, p_name AS name, p_type AS city FROM part")
def src_csv_header(spark, d):
    df = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("cluster"),
        F.col("p_name").alias("name"), F.col("p_type").alias("city"),
    )
    return text.delimited(spark, _roundtrip(spark, df), "id bigint, cluster string, name string, city string", True)


@query("src_column_subset", "SELECT p_brand, p_type, p_size, p_retailprice FROM part")
def src_column_subset(spark, d):
    return text.positions(table(spark, d, "part"), 3, 6)


@query(
    "src_csv_append_col",
    """SELECT vec_id, label, 'group_' || label AS label_name FROM embeddings""",
)
def src_csv_append_col(spark, d):
    src = _roundtrip(spark, table(spark, d, "embeddings").select("vec_id", "label"))
    name = F.concat(F.lit("group_"), F.col("label").cast("string"))
    return text.append_column(spark, src, scratch_path(spark, "csv"), "vec_id bigint, label int", "label_name", name)


@query(
    "src_xml_pages",
    """SELECT page_id, url AS title, length(html) AS n_chars FROM pages""",
)
def src_xml_pages(spark, d):
    path = scratch_path(spark, "xml")
    html = F.struct(F.col("html").alias("_VALUE"), F.lit("preserve").alias("_space"))
    table(spark, d, "pages").select("page_id", F.col("url").alias("title"), F.struct(html.alias("text")).alias("revision")).write.format(
        "xml"
    ).option("rowTag", "page").option("rootTag", "dump").save(path)
    schema = "page_id bigint, title string, revision struct<text: struct<_VALUE: string, _space: string>>"
    pages = text.xml_rows(spark, path, "page", schema)
    return pages.select("page_id", "title", F.length("revision.text._VALUE").cast("bigint").alias("n_chars"))


LABELLED = "documents JOIN labels USING (doc_id)"


@query(
    "src_labelled_lines",
    f"""WITH l AS (SELECT CASE quality WHEN 1 THEN 'pos' ELSE 'neg' END AS label,
                lower(unnest(string_split(text, chr(10)))) AS text FROM {LABELLED})
        SELECT label, text, count(*) AS n FROM l WHERE text <> '' GROUP BY 1, 2""",
)
def src_labelled_lines(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    paths = {
        name: staged_text(docs.filter(F.col("quality") == q).select("text"), name)
        for q, name in ((1, "pos"), (0, "neg"))
    }
    return text.labelled_lines(spark, paths).groupBy("label", "text").agg(F.count("*").alias("n"))


@query(
    "src_corpus_folds",
    f"""WITH l AS (SELECT CASE quality WHEN 1 THEN 'pos' ELSE 'neg' END AS label,
               cast(substr(source, 4) AS INTEGER) * 50 // 100 + 1 AS fold,
               unnest(string_split(text, chr(10))) AS sentence FROM {LABELLED})
        SELECT label, fold, count(*) AS n, sum(length(sentence))::BIGINT AS chars FROM l GROUP BY 1, 2""",
)
def src_corpus_folds(spark, d):
    root = scratch_path(spark, "corpus")
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    tag = F.format_string("cv%03d", F.substring("source", 4, 10).cast("int") * 50)
    for q, name in ((1, "pos"), (0, "neg")):
        docs.filter(F.col("quality") == q).select("text", tag.alias("tag")).write.partitionBy("tag").text(f"{root}/{name}")
    lines = text.corpus(spark, root)
    return lines.groupBy("label", "fold").agg(
        F.count("*").alias("n"), F.sum(F.length("sentence").cast("bigint")).alias("chars")
    )


@query(
    "html_table_cells",
    """SELECT s_suppkey AS page_id, 1 AS row_no, s_name AS name, cast(s_nationkey AS VARCHAR) AS nation,
              'A & B' AS note FROM supplier""",
)
def html_table_cells(spark, d):
    # a page per supplier: a decoy table, then the one that is wanted
    html = F.concat(
        F.lit("<html><table><tr><td>nav</td></tr></table><table class='x'><tr><th>name</th><th>nation<th>note</tr><tr><td> "),
        "s_name", F.lit("</td><td><b>"), F.col("s_nationkey").cast("string"), F.lit("</b></td><td>A &amp; B</td></tr></table>"),
    )
    pages = table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_id"), html.alias("html"))
    return markup.table_rows(markup.table_cells(pages), 1, ["name", "nation", "note"])


@query(
    "html_list_items",
    r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS item,
                unnest(range(len(regexp_extract_all(html, '<li>(.*?)</li>', 1))))::INTEGER AS item_no FROM pages)
        SELECT page_id, item_no, trim(replace(replace(replace(replace(replace(regexp_replace(item, '<[^>]*>', '', 'g'),
          '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&')) AS text FROM l""",
)
def html_list_items(spark, d):
    return markup.list_items(table(spark, d, "pages"))


@query(
    "src_libsvm",
    """SELECT label, count(*) AS n, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 4) AS total
       FROM (SELECT label::DOUBLE AS label, embedding FROM embeddings) GROUP BY 1""",
)
def src_libsvm(spark, d):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    path = scratch_path(spark, "libsvm")
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    table(spark, d, "embeddings").select(
        F.col("label").cast("double").alias("label"), array_to_vector(doubles).alias("features")
    ).write.format("libsvm").save(path)
    width = table(spark, d, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    back = spark.read.format("libsvm").option("numFeatures", str(width)).load(path)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return back.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(total), 4).alias("total"))


@query("file_inventory")
def file_inventory(spark, d):
    root = scratch_path(spark, "files")
    table(spark, d, "events").write.partitionBy("event_type").parquet(root)
    files = text.file_inventory(spark, root, "*.parquet")
    kind = F.regexp_extract("path", "event_type=([^/]*)", 1)
    counts = files.groupBy(kind.alias("kind")).agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))
    return counts.orderBy(F.desc("bytes"), "kind").limit(3)


@query(
    "snk_csv_roundtrip",
    "SELECT n_name AS nation, count(*) AS n, round(avg(c_acctbal) + 1e-7, 4) AS mean FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def snk_csv_roundtrip(spark, d):
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    per = table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("n"), F.round(F.avg("c_acctbal") + F.lit(1e-7), 4).alias("mean")
    )
    out = per.join(nation, "c_nationkey").select(F.col("n_name").alias("nation"), "n", "mean")
    path = scratch_path(spark, "csv")
    text.write_csv(out, path, single_file=True)  # 25 nations at any scale
    return text.delimited(spark, path, "nation string, n bigint, mean double", True)


@query(
    "preview_count",
    """SELECT 'lineitem' AS name, count(*) AS n, 11::BIGINT AS n_cols, min(l_orderkey) AS first_key FROM lineitem
       UNION ALL SELECT 'orders', count(*), 6, min(o_orderkey) FROM orders
       UNION ALL SELECT 'customer', count(*), 5, min(c_custkey) FROM customer""",
)
def preview_count(spark, d):
    out = None
    for name in ("lineitem", "orders", "customer"):
        df = table(spark, d, name)
        row = df.agg(F.count("*").alias("n"), F.min(df.columns[0]).alias("first_key"))
        row = row.select(F.lit(name).alias("name"), "n", F.lit(len(df.columns)).cast("bigint").alias("n_cols"), "first_key")
        out = row if out is None else out.unionByName(row)
    return out
