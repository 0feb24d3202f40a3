"""Relational queries on the driver's tables: joins, windows, sets, aggregates, histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import history
from ..operators import relational as R
from .common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""SELECT doc_id, quality, lang, CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'both' WHEN d.doc_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS origin
FROM documents d FULL JOIN (SELECT doc_id, quality FROM labels) l USING (doc_id)""")
def j1_outer_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.outer_with_indicator(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality"), ["doc_id"])


@query("""SELECT k.id, coalesce(b.text, d.text) AS body, CASE WHEN b.text IS NOT NULL THEN 'benchmark' WHEN d.text IS NOT NULL THEN 'documents' END AS body_source,
  coalesce(l.quality, e.label) AS mark, CASE WHEN l.quality IS NOT NULL THEN 'labels' WHEN e.label IS NOT NULL THEN 'embeddings' END AS mark_source,
  d.doc_id IS NOT NULL AS in_documents, l.doc_id IS NOT NULL AS in_labels, b.item_id IS NOT NULL AS in_benchmark, e.vec_id IS NOT NULL AS in_embeddings
FROM (SELECT doc_id AS id FROM documents UNION SELECT doc_id FROM labels UNION SELECT item_id FROM benchmark UNION SELECT vec_id FROM embeddings) k
LEFT JOIN documents d ON d.doc_id = k.id LEFT JOIN labels l ON l.doc_id = k.id LEFT JOIN benchmark b ON b.item_id = k.id LEFT JOIN embeddings e ON e.vec_id = k.id""")
def j2_fused_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n, k, *c: table(spark, sf_dir, n).select(F.col(k).alias("id"), *c)
    sources = {"documents": t("documents", "doc_id", "text"), "labels": t("labels", "doc_id", "quality"), "benchmark": t("benchmark", "item_id", "text"), "embeddings": t("embeddings", "vec_id", "label")}
    return R.fuse(sources, ["id"], {"body": [("benchmark", "text"), ("documents", "text")], "mark": [("labels", "quality"), ("embeddings", "label")]})


@query("""SELECT d.doc_id, list_transform(list(struct_pack(t := turn, r := role) ORDER BY turn), lambda x: x.r) AS roles FROM documents d LEFT JOIN conversations c ON c.conv_id = d.doc_id GROUP BY d.doc_id""".replace("list_transform(list(struct_pack(t := turn, r := role) ORDER BY turn), lambda x: x.r)", "array_to_string(list(role ORDER BY turn) FILTER (role IS NOT NULL), ',')"))
def j3_nested_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    kids = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("kids"))
    d = table(spark, sf_dir, "documents").select("doc_id").join(kids, "doc_id", "left")
    return d.select("doc_id", F.when(F.col("kids").isNotNull(), F.array_join(F.col("kids.role"), ",")).alias("roles"))


@query("SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j4_dimension_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("s_suppkey", "n_name", "r_name")


@query("""WITH a AS (SELECT c_nationkey AS country, p_brand AS brand, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey GROUP BY ALL), r AS (SELECT s_nationkey AS country, p_brand AS brand, count(*) AS reach FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE s_nationkey <> 3 GROUP BY ALL)
SELECT country, brand, n, reach FROM a LEFT JOIN r USING (country, brand)""")
def j6_composite_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each nation buys of each brand, with what it supplies of it looked up by both; one nation is not in the table."""
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand")), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_suppkey", "brand")
    bought = l.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("country")), F.col("o_custkey") == F.col("c_custkey"))
    sold = l.join(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("country")), F.col("l_suppkey") == F.col("s_suppkey")).where("country <> 3")
    reach = sold.groupBy("country", "brand").agg(F.count(F.lit(1)).alias("reach"))
    return bought.groupBy("country", "brand").agg(F.count(F.lit(1)).alias("n")).join(reach, ["country", "brand"], "left")


@query("""SELECT p.event_id, CASE WHEN epoch_us(p.ts) - epoch_us(s.ts) <= 86400000000 THEN s.event_id END AS signup_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY ALL) s ON p.user_id = s.user_id AND p.ts > s.ts""")
def j7_asof_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", F.expr("unix_micros(cast(ts as timestamp))"))
    buys = e.where("event_type = 'purchase'").select("event_id", "user_id", "at")
    signs = e.where("event_type = 'signup'").select("user_id", F.col("at").alias("sign_at"), F.col("event_id").alias("signup_id"))
    return R.as_of(buys, signs, ["user_id"], "at", "sign_at", ["signup_id"], within=86_400_000_000, order=["signup_id"]).select("event_id", "signup_id")


@query("""SELECT e.event_id, coalesce(bool_or(x.event_type = 'signup'), (SELECT count(*) = 0 FROM events z WHERE z.user_id = any_value(e.user_id) AND z.event_type IN ('signup', 'error'))) AS in_debate
FROM (SELECT * FROM events WHERE event_type = 'view') e ASOF LEFT JOIN (SELECT user_id, ts, max_by(event_type, event_id) AS event_type FROM events WHERE event_type IN ('signup', 'error') GROUP BY ALL) x ON e.user_id = x.user_id AND e.ts > x.ts GROUP BY e.event_id""")
def j8_agenda_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest agenda mark strictly before decides; where a key has no marks at all, the answer is yes."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    marks = e.where("event_type IN ('signup', 'error')").select("user_id", F.col("ts").alias("mark_ts"), (F.col("event_type") == "signup").alias("debate"), F.col("event_id").alias("mark_id"))
    turns = e.where("event_type = 'view'")
    found = R.as_of(turns, marks, ["user_id"], "ts", "mark_ts", ["debate"], order=["mark_id"])
    any_mark = marks.select("user_id").distinct().withColumn("has", F.lit(True))
    return found.join(any_mark, "user_id", "left").select("event_id", F.coalesce("debate", F.col("has").isNull()).alias("in_debate"))


@query("""SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn), 99)::BIGINT AS turn_end FROM conversations""")
def j9_turn_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return R.interval_ends(c, ["conv_id"], "turn", "turn_end", F.lit(99).cast("long"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role <> 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS introduction FROM conversations""")
def j10_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return R.carry_forward(c, ["conv_id"], ["turn"], F.when(F.col("role") != "user", F.col("text")), "introduction").select("conv_id", "turn", "introduction")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def j11_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j16_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "lang")


@query("""SELECT l.doc_id, quality, toxic, source FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
def j17_labels_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").select("doc_id", "quality", "toxic", "source")


@query("""SELECT u.user_id, clicks, views, purchases, c_mktsegment FROM (SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1) u JOIN customer ON c_custkey = u.user_id""")
def j18_pivot_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).count().fillna(0)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return p.join(c, "user_id").select("user_id", F.col("click").alias("clicks"), F.col("view").alias("views"), F.col("purchase").alias("purchases"), "c_mktsegment")


_STATES = """WITH s AS (SELECT user_id, (ts::DATE - DATE '2024-01-01')::BIGINT AS day, max_by(event_type, struct_pack(t := ts, e := event_id)) AS state FROM events GROUP BY ALL)"""


@query(_STATES + """ SELECT a.state AS from_state, b.state AS to_state, count(*) AS n FROM s a JOIN s b ON a.user_id = b.user_id AND b.day = a.day + 1 GROUP BY ALL""")
def j19_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("day", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long"))
    s = e.groupBy("user_id", "day").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"))
    return R.transitions(s, ["user_id"], "day", "state")


@query("""WITH s AS (SELECT o_custkey, year(o_orderdate)::BIGINT AS yr, max_by(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS state FROM orders GROUP BY ALL), l AS (SELECT *, lag(state) OVER w AS before, lag(yr) OVER w AS last FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY yr))
SELECT yr, before AS from_state, state AS to_state, count(*) AS n FROM l WHERE last = yr - 1 AND before <> state GROUP BY ALL""")
def w13_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose last order of a year has another state than that of the year before."""
    s = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("yr")).agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("state"))
    w = Window.partitionBy("o_custkey").orderBy("yr")
    l = s.withColumns({"from_state": F.lag("state").over(w), "last": F.lag("yr").over(w)}).where("last = yr - 1 AND from_state <> state")
    return l.groupBy("yr", "from_state", F.col("state").alias("to_state")).agg(F.count(F.lit(1)).alias("n"))



@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def j20_silent_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(e, "c_custkey", "left_anti").select("c_custkey")


@query("""SELECT conv_id, turn, coalesce(bool_or(role = 'system') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), false) AS near_system FROM conversations""")
def j21_neighbour_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.near_hit(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role") == "system", 1, "near_system").select("conv_id", "turn", "near_system")


@query("""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS orders, c_custkey IN (SELECT user_id FROM events) AS visits, c_nationkey IN (SELECT s_nationkey FROM supplier) AS has_supplier FROM customer""")
def j22_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sets = {"orders": ("orders", "o_custkey", "c_custkey"), "visits": ("events", "user_id", "c_custkey"), "has_supplier": ("supplier", "s_nationkey", "c_nationkey")}
    for name, (t, theirs, ours) in sets.items():
        c = c.join(table(spark, sf_dir, t).select(F.col(theirs).alias(ours)).distinct().withColumn(name, F.lit(True)), ours, "left")
    return c.select("c_custkey", *[F.coalesce(n, F.lit(False)).alias(n) for n in sets])


@query("""WITH y AS (SELECT c_nationkey, year(o_orderdate)::INT AS yr, max_by(o_custkey, struct_pack(p := o_totalprice, k := o_orderkey)) AS top FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT a.c_nationkey, a.yr, a.top, b.top AS top_before FROM y a LEFT JOIN y b ON a.c_nationkey = b.c_nationkey AND b.yr = a.yr - 1""")
def j23_last_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    y = o.groupBy("c_nationkey", F.year("o_orderdate").alias("yr")).agg(F.max_by("o_custkey", F.struct("o_totalprice", "o_orderkey")).alias("top"))
    before = y.select("c_nationkey", (F.col("yr") + 1).alias("yr"), F.col("top").alias("top_before"))
    return y.join(before, ["c_nationkey", "yr"], "left")


@query("""SELECT doc_id FROM documents d WHERE contains(d.text, 'rights') AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def j24_both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("text").contains("rights")).join(table(spark, sf_dir, "labels").where("quality = 1"), "doc_id", "left_semi").select("doc_id")


# --- windows, ranking, sets ---

@query("""SELECT source, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE lang WHEN 'es' THEN 1 WHEN 'fr' THEN 2 WHEN 'en' THEN 3 ELSE 4 END, doc_id) AS rn FROM documents) WHERE rn = 1""")
def w1_best_by_pref(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "lang")
    return R.keep_one(d, ["source"], [R.preference(F.col("lang"), ["es", "fr", "en"]), F.col("doc_id")])


@query("""SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY (role = 'system') DESC, CASE role WHEN 'assistant' THEN 1 ELSE 2 END, turn) AS rn FROM conversations) WHERE rn = 1""")
def w2_best_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return R.keep_one(c, ["conv_id"], [F.desc(F.col("role") == "system"), R.preference(F.col("role"), ["assistant"]), F.col("turn")])


@query("""SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) = 1 THEN 'general_debate' ELSE 'other_intervention' END AS kind FROM conversations""")
def w3_longest_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy(F.desc(F.length("text")), "turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.row_number().over(w) == 1, "general_debate").otherwise("other_intervention").alias("kind"))


@query("""SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents WHERE n_chars >= 600) WHERE rn = 1""")
def w4_longest_over_least(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.keep_one(table(spark, sf_dir, "documents").where("n_chars >= 600").select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")]).drop("n_chars")


@query("SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text")
def w5_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"))


@query("""WITH s AS (SELECT year(o_orderdate)::INT AS yr, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY yr ORDER BY n DESC, o_orderpriority)::INT AS place FROM s""")
def w6_rank_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("yr"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("yr").orderBy(F.desc("n"), "o_orderpriority")))


@query("""WITH d AS (SELECT event_type, ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT *, avg(n) OVER w AS previous_mean, max(n) OVER w AS previous_max FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def w7_previous_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return R.previous_stats(d, ["event_type"], "day", "n", 10)


@query("""WITH a AS (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS turn FROM documents)
SELECT lang, source, doc_id, pick::INT AS pick FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY turn, doc_id) AS pick FROM a) WHERE pick <= 6""")
def w8_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.round_robin(table(spark, sf_dir, "documents").select("lang", "source", "doc_id"), ["lang"], "source", [F.col("doc_id")], 6)


@query("""SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END, turn) - 1)::BIGINT AS seq FROM conversations""")
def w9_role_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy(R.preference(F.col("role"), ["system", "user"]), "turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.row_number().over(w) - 1).cast("long").alias("seq"))


@query("""WITH d AS (SELECT DISTINCT user_id, (ts::DATE - DATE '2024-01-01')::BIGINT AS day FROM events WHERE event_type = 'purchase'), n AS (SELECT *, CASE WHEN lag(day) OVER w IS NULL OR day - lag(day) OVER w > 3 THEN 1 ELSE 0 END AS fresh FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY day) AS island FROM n)
SELECT user_id, island::BIGINT AS island, min(day) AS first_day, max(day) AS last_day, count(*) AS n FROM i GROUP BY ALL""")
def w10_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long").alias("day")).distinct()
    return R.islands(d, ["user_id"], "day", 3).groupBy("user_id", "island").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT user_id, (ts::DATE - DATE '2024-01-01')::BIGINT AS n, bool_or(event_type = 'purchase') AS debate, bool_and(event_type = 'error') AS special FROM events GROUP BY ALL),
o AS (SELECT *, max((n >= 5)::INT) OVER (PARTITION BY user_id ORDER BY n) AS started FROM m), w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n) AS step FROM o WHERE started = 1 AND NOT special),
f AS (SELECT *, coalesce(step - lag(step) OVER (PARTITION BY user_id ORDER BY step) > 8, true)::INT AS fresh FROM w WHERE debate AND step <= 70), i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY step) AS island FROM f),
s AS (SELECT user_id, island, count(*) AS size, min(step) AS a, max(step) AS b FROM i GROUP BY ALL), c AS (SELECT *, max(island) OVER (PARTITION BY user_id) AS last FROM s), p AS (SELECT * FROM c WHERE size >= 3 OR island = last QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY island) = 1)
SELECT w.user_id, n, debate FROM w JOIN p USING (user_id) WHERE step <= 70 AND step BETWEEN a AND b""")
def w10_meeting_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The debate's meetings of each user's days: a purchase marks the debate, errors are specials, days from the fifth on are autumn."""
    e = table(spark, sf_dir, "events").withColumn("n", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long"))
    m = e.groupBy("user_id", "n").agg(F.bool_or(F.col("event_type") == "purchase").alias("debate"), F.bool_and(F.col("event_type") == "error").alias("special")).withColumn("autumn", F.col("n") >= 5)
    return R.debate_span(m, ["user_id"])


@query("""WITH m AS (SELECT user_id, (ts::DATE - DATE '2024-01-01')::BIGINT AS n, count(*) FILTER (event_type = 'click') AS speeches, true AS found FROM events GROUP BY ALL),
t AS (SELECT *, sum(speeches) OVER (PARTITION BY user_id ORDER BY n) AS total, sum((speeches = 0)::INT) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS silent FROM m),
s AS (SELECT *, sum((silent AND total >= 5)::INT) OVER (PARTITION BY user_id ORDER BY n) AS stopped FROM t)
SELECT user_id, n, speeches, found FROM s WHERE stopped = 0""")
def w11_running_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("n", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long"))
    m = e.groupBy("user_id", "n").agg(F.count_if(F.col("event_type") == "click").alias("speeches")).withColumn("found", F.lit(True))
    return R.running_end(m, ["user_id"], quiet=3, under_way=5)


@query("SELECT user_id, min(event_id) AS first_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1")
def w12_first_on_or_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).groupBy("user_id").agg(F.min("event_id").alias("first_id"))


@query("SELECT lang, doc_id, n_chars, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS place FROM documents) WHERE place <= 5")
def w14_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_per_key(table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars"), ["lang"], [F.desc("n_chars"), F.col("doc_id")], 5, "place")


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def w17_nlargest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 0 WHEN p_size < 25 THEN 1 WHEN p_size < 40 THEN 2 ELSE 3 END::INT AS bucket FROM part")
def w18_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.numbers import bucket

    return table(spark, sf_dir, "part").select("p_partkey", bucket(F.col("p_size"), [10, 25, 40]).alias("bucket"))


@query("SELECT doc_id AS id FROM documents UNION SELECT item_id FROM benchmark UNION SELECT conv_id FROM conversations")
def x1_union_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [table(spark, sf_dir, t).select(F.col(c).alias("id")) for t, c in (("documents", "doc_id"), ("benchmark", "item_id"), ("conversations", "conv_id"))]
    return ids[0].union(ids[1]).union(ids[2]).distinct()


@query("SELECT doc_id AS id, text, lang, NULL::VARCHAR AS role FROM documents UNION ALL SELECT conv_id, text, NULL, role FROM conversations")
def x2_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    return d.unionByName(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "text", "role"), allowMissingColumns=True)


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def x3_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT doc_id AS k FROM documents EXCEPT SELECT doc_id FROM labels")
def x3_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k")).subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def x4_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


# --- histories ---

@query("""WITH r AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT * FROM r WHERE rn = 1 OR before <> event_type), l AS (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY 1),
v AS (SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM s)
SELECT user_id, event_type, valid_from, valid_to, valid_to IS NULL AS is_current, coalesce(valid_to, last_ts) AS last_checked FROM v JOIN l USING (user_id)""")
def h1_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.from_log(table(spark, sf_dir, "events"), "user_id", "ts", ["event_type"], ["event_id"])


@query("""SELECT s_suppkey, s_nationkey, s_acctbal, '2024-01-01' AS valid_from, CASE WHEN s_suppkey % 5 = 0 THEN '2024-02-01' END AS valid_to, s_suppkey % 5 <> 0 AS is_current,
  CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 THEN '2024-02-01' ELSE '2024-01-01' END AS last_checked FROM (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 2 = 0 THEN 1.0 ELSE s_acctbal END AS s_acctbal FROM supplier)
UNION ALL SELECT s_suppkey, s_nationkey + 1, s_acctbal, '2024-02-01', NULL, true, '2024-02-01' FROM supplier WHERE s_suppkey % 5 = 0""")
def h1_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second observation of suppliers: every fifth has moved, every third was not seen unless it moved, even ones have a new balance."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    day = lambda d: F.lit(d)  # noqa: E731  (dates as ISO text, as the histories on file have them)
    first = s.select("*", day("2024-01-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"), F.lit(True).alias("is_current"), day("2024-01-01").alias("last_checked"))
    moved = F.col("s_suppkey") % 5 == 0
    batch = s.where(moved | (F.col("s_suppkey") % 3 != 0)).select("s_suppkey", (F.col("s_nationkey") + moved.cast("int")).alias("s_nationkey"), F.when(moved, F.col("s_acctbal")).when(F.col("s_suppkey") % 2 == 0, F.lit(1.0)).alias("s_acctbal"))
    return history.apply_batch(first, batch, "s_suppkey", ["s_nationkey"], day("2024-02-01"), ["s_acctbal"])


@query("SELECT sha256(text) AS sha256, min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text")
def h4_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.snapshots(table(spark, sf_dir, "documents"), "text", ["doc_id"])
