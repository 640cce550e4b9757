"""Market, quality, monitor and search-share queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.functions.text import strip_suffix
from bazaarlens.operators import dedup, market, quality, search
from bazaarlens.plans.registry import div, query, r
from bazaarlens.plans.views import ctes
from bazaarlens.session import fresh_path
from bazaarlens.sources.readers import parse_search, search_items
from bazaarlens.sources.tables import table

NEW, PREV = "05/2000", "04/2000"


def sales(spark, sf, fine=False):
    """Market table; ``fine`` makes a brand per customer, so that brands come and go."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    order = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    brand = F.when(F.col("p_brand") == "Brand#1", "Undefined").when(F.col("p_brand") == "Brand#2", "").otherwise(F.col("p_brand"))
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.date_format("o_orderdate", "MM/yyyy").alias("time"),
            F.col("o_orderdate").alias("period"),
            (F.concat_ws("/", brand, F.col("o_custkey").cast("string")) if fine else brand).alias("brand"),
            F.col("c_mktsegment").alias("platform"),
            F.col("p_type").alias("partner_category"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("sales"),
        )
    )


def sales_cte(fine=False):
    brand = "CASE p_brand WHEN 'Brand#1' THEN 'Undefined' WHEN 'Brand#2' THEN '' ELSE p_brand END"
    return (
        "sales",
        f"""SELECT strftime(o_orderdate, '%m/%Y') AS time, year(o_orderdate)::INT AS year, {brand + " || '/' || o_custkey" if fine else brand} AS brand,
            c_mktsegment AS platform, p_type AS partner_category, l_partkey AS sku_id, l_extendedprice::DECIMAL(18,2) AS sales
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey""",
    )


FUZZY_SQL = "('Undefined', 'No Brand', 'Unknown', 'Other', '')"


@query("mkt1_normalize", "SELECT p_partkey, regexp_replace(p_name || CASE p_size % 3 WHEN 0 THEN '_old' WHEN 1 THEN '_new' ELSE '_old_new' END, '(_old|_new)$', '') AS sku_id FROM part")
def mkt1_normalize(spark, sf):
    tail = F.when(F.col("p_size") % 3 == 0, "_old").when(F.col("p_size") % 3 == 1, "_new").otherwise("_old_new")
    return table(spark, sf, "part").select("p_partkey", strip_suffix(F.concat("p_name", tail)).alias("sku_id"))


def _in_year(day: str, year: int):
    """A range that the scan can use."""
    return (F.col(day) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (F.col(day) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))


def _snapshot(spark, sf, year, suffix):
    return (
        sales(spark, sf)
        .filter(_in_year("period", year))
        .groupBy(F.concat(F.col("sku_id").cast("string"), F.lit(suffix)).alias("sku_id"), "partner_category")
        .agg(F.sum("sales").cast("double").alias("revenue"), F.lit(f"tag-{year}").alias("tag"))
    )


SNAP = [
    sales_cte(),
    ("o", "SELECT sku_id::VARCHAR AS sku_id, partner_category, sum(sales)::DOUBLE AS revenue FROM sales WHERE year = 1997 GROUP BY ALL"),
    ("n", "SELECT sku_id::VARCHAR AS sku_id, partner_category, sum(sales)::DOUBLE AS revenue FROM sales WHERE year = 1998 GROUP BY ALL"),
]
MERGE_SQL = ctes(*SNAP) + """SELECT coalesce(n.sku_id, o.sku_id) AS sku_id, coalesce(n.partner_category, o.partner_category) AS partner_category,
  coalesce(n.revenue, o.revenue) AS revenue, {tag} AS tag FROM o FULL JOIN n ON o.sku_id = n.sku_id AND o.partner_category = n.partner_category"""


@query("mkt2_merge", MERGE_SQL.format(tag="CASE WHEN n.sku_id IS NULL THEN 'tag-1997' ELSE 'tag-1998' END"))
def mkt2_merge(spark, sf):
    return dedup.merge_master(_snapshot(spark, sf, 1997, "_old"), _snapshot(spark, sf, 1998, "_new"))


@query("mkt2_merge_keep_tags", MERGE_SQL.format(tag="CASE WHEN o.sku_id IS NULL THEN 'tag-1998' ELSE 'tag-1997' END"))
def mkt2_merge_keep_tags(spark, sf):
    return dedup.merge_master(_snapshot(spark, sf, 1997, "_old"), _snapshot(spark, sf, 1998, "_new"), keep_tags=["tag"])


COMBOS = (
    "combos",
    """SELECT combo_id, partner_category, n::DOUBLE / sum(n) OVER (PARTITION BY combo_id) * CASE WHEN combo_id % 10 = 0 THEN 1.2 ELSE 1.0 END::DOUBLE AS coefficient_in_combo
       FROM (SELECT p_partkey % 50 AS combo_id, p_type AS partner_category, count(*) AS n FROM part GROUP BY ALL)""",
)


def combos(spark, sf):
    n = table(spark, sf, "part").groupBy((F.col("p_partkey") % 50).alias("combo_id"), F.col("p_type").alias("partner_category")).agg(F.count("*").alias("n"))
    total = n.groupBy("combo_id").agg(F.sum("n").alias("t"))
    factor = F.when(F.col("combo_id") % 10 == 0, 1.2).otherwise(1.0)
    return n.join(total, "combo_id").select("combo_id", "partner_category", (F.col("n") / F.col("t") * factor).alias("coefficient_in_combo"))


@query(
    "mkt3_combo",
    ctes(COMBOS, ("s", "SELECT l_partkey % 70 AS combo_id, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue FROM lineitem GROUP BY 1"))
    + "SELECT combo_id, partner_category, revenue * coalesce(coefficient_in_combo, 1.0::DOUBLE) AS allocated FROM s LEFT JOIN combos USING (combo_id)",
)
def mkt3_combo(spark, sf):
    s = table(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 70).alias("combo_id")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    )
    return market.allocate_combo(s, combos(spark, sf)).select("combo_id", "partner_category", "allocated")


@query(
    "mkt4_periods",
    "SELECT year(o_orderdate)::INT AS period, o_orderstatus, count(*) AS orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS value FROM orders GROUP BY ALL",
)
def mkt4_periods(spark, sf):
    orders = table(spark, sf, "orders")
    span = orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    out = fresh_path(spark, "periods")

    def build(df):
        return df.groupBy("period", "o_orderstatus").agg(
            F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value")
        )

    years = [str(y) for y in range(span["a"], span["b"] + 1)]
    market.build_periods(orders, out, F.year("o_orderdate").cast("string"), build, years)
    return spark.read.parquet(out).select("period", "o_orderstatus", "orders", "value")


@query(
    "mkt5_share",
    ctes(sales_cte(), ("s", "SELECT time, partner_category, brand, sum(sales) AS s FROM sales GROUP BY ALL"))
    + f"SELECT time, partner_category, brand, s::DOUBLE AS sales, {r(div('s', 'sum(s) OVER (PARTITION BY time, partner_category)'))} AS share FROM s",
)
def mkt5_share(spark, sf):
    out = market.market_share(sales(spark, sf), ["time", "partner_category"], ["brand"])
    return out.withColumn("share", F.bround("share", 6))


@query(
    "mkt6_top_sellers",
    ctes(sales_cte(), ("s", "SELECT partner_category, platform, brand, sum(sales) AS s FROM sales GROUP BY ALL"))
    + """SELECT partner_category, platform, brand, s::DOUBLE AS sales, row_number() OVER (PARTITION BY partner_category, platform ORDER BY s DESC, brand)::INT AS position
      FROM s QUALIFY position <= 3""",
)
def mkt6_top_sellers(spark, sf):
    out = market.top_sellers(sales(spark, sf), ["partner_category", "platform"], "brand", 3)
    return out.withColumn("sales", F.col("sales").cast("double"))


# quality ---------------------------------------------------------------------------------


def _year(spark, sf, y):
    return sales(spark, sf).filter(_in_year("period", y)).withColumnRenamed("sales", "revenue")


@query(
    "qc1_drift",
    ctes(sales_cte(), ("t", """SELECT partner_category, coalesce(sum(sales) FILTER (year = 1999), 0)::DOUBLE AS before,
      coalesce(sum(sales) FILTER (year = 2000), 0)::DOUBLE AS after FROM sales WHERE year IN (1999, 2000) GROUP BY ALL"""))
    + f"SELECT *, {r(div('after - before', 'before') + ' * 100', 2)} AS diff_pct, coalesce(abs({r(div('after - before', 'before') + ' * 100', 2)}) > 5, false) AS flagged FROM t",
)
def qc1_drift(spark, sf):
    return quality.revenue_drift(_year(spark, sf, 1999), _year(spark, sf, 2000))


NULL_CATEGORY = "CASE WHEN partner_category <> (SELECT min(partner_category) FROM sales) THEN partner_category END"


@query(
    "qc1_null_category",
    ctes(sales_cte(), ("t", f"""SELECT {NULL_CATEGORY} AS partner_category, coalesce(sum(sales) FILTER (year = 1999), 0)::DOUBLE AS before,
      coalesce(sum(sales) FILTER (year = 2000), 0)::DOUBLE AS after FROM sales WHERE year IN (1999, 2000) GROUP BY 1"""))
    + f"SELECT *, {r(div('after - before', 'before') + ' * 100', 2)} AS diff_pct, coalesce(abs({r(div('after - before', 'before') + ' * 100', 2)}) > 5, false) AS flagged FROM t",
)
def qc1_null_category(spark, sf):
    """Rows without a category are compared with their like."""
    least = sales(spark, sf).agg(F.min("partner_category")).first()[0]
    before, after = (_year(spark, sf, y).withColumn("partner_category", F.nullif("partner_category", F.lit(least))) for y in (1999, 2000))
    return quality.revenue_drift(before, after)


@query(
    "mkt5_null_group",
    ctes(sales_cte(), ("s", f"SELECT time, {NULL_CATEGORY} AS partner_category, brand, sum(sales) AS s FROM sales GROUP BY ALL"))
    + f"SELECT time, partner_category, brand, s::DOUBLE AS sales, {r(div('s', 'sum(s) OVER (PARTITION BY time, partner_category)'))} AS share FROM s",
)
def mkt5_null_group(spark, sf):
    rows = sales(spark, sf)
    least = rows.agg(F.min("partner_category")).first()[0]
    out = market.market_share(rows.withColumn("partner_category", F.nullif("partner_category", F.lit(least))), ["time", "partner_category"], ["brand"])
    return out.withColumn("share", F.bround("share", 6))


@query(
    "qc3_combos",
    ctes(COMBOS, ("s", "SELECT combo_id, count(*) AS n_rows, sum(coefficient_in_combo::DECIMAL(18,6))::DOUBLE AS coef_sum FROM combos GROUP BY 1"))
    + "SELECT *, n_rows >= 2 AND abs(coef_sum - 1.0) <= 0.01 AS ok FROM s",
)
def qc3_combos(spark, sf):
    return quality.validate_combos(combos(spark, sf))


@query("qc4_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) >= 2")
def qc4_duplicates(spark, sf):
    return dedup.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "qc5_reconcile",
    """WITH a AS (SELECT year(o_orderdate)::INT AS year, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS before FROM orders GROUP BY 1),
       b AS (SELECT year(o_orderdate)::INT AS year, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS after FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
       SELECT year, coalesce(before, 0) AS before, coalesce(after, 0) AS after, """
    + r(div("coalesce(after, 0) - coalesce(before, 0)", "before") + " * 100", 4)
    + " AS gap_pct, coalesce(abs(" + r(div("coalesce(after, 0) - coalesce(before, 0)", "before") + " * 100", 4)
    + ") <= 50, coalesce(after, 0) = 0) AS ok FROM a FULL JOIN b USING (year)",
)
def qc5_reconcile(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("decimal(18,2)").alias("sales"))
    return quality.reconcile_totals(orders, sales(spark, sf).select(F.year("period").alias("year"), "sales"), ["year"], "sales", 50.0)


@query(
    "qc6_gate",
    ctes(
        COMBOS,
        ("c", "SELECT combo_id, count(*) >= 2 AND abs(sum(coefficient_in_combo::DECIMAL(18,6))::DOUBLE - 1.0) <= 0.01 AS ok FROM combos GROUP BY 1"),
        ("d", "SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber"),
        (
            "v",
            """SELECT 'combos' AS "check", count(*) AS n_rows, count(*) FILTER (NOT ok) AS failures FROM c
               UNION ALL SELECT 'duplicates', count(*), count(*) FILTER (n > 1) FROM d""",
        ),
    )
    + """SELECT *, failures = 0 AS passed FROM v UNION ALL SELECT 'GATE', sum(n_rows)::BIGINT, sum(failures)::BIGINT, bool_and(failures = 0) FROM v""",
)
def qc6_gate(spark, sf):
    keys = dedup.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 1)
    return quality.qc_gate(
        quality.verdict(quality.validate_combos(combos(spark, sf)), "combos", F.col("ok")),
        quality.verdict(keys, "duplicates", F.col("n_rows") == 1),
    )


# monitor ---------------------------------------------------------------------------------

SPIKE = [
    sales_cte(),
    (
        "t",
        f"""SELECT coalesce(sum(sales) FILTER (time = '{NEW}' AND brand IN {FUZZY_SQL}), 0)::DOUBLE AS undefined_new,
            coalesce(sum(sales) FILTER (time = '{PREV}' AND brand IN {FUZZY_SQL}), 0)::DOUBLE AS undefined_prev,
            coalesce(sum(sales) FILTER (time = '{NEW}'), 0)::DOUBLE AS total_new, coalesce(sum(sales) FILTER (time = '{PREV}'), 0)::DOUBLE AS total_prev FROM sales""",
    ),
    (
        "spike",
        f"""SELECT *, coalesce({div('undefined_new', 'total_new')}, 0) AS share_new, coalesce({div('undefined_prev', 'total_prev')}, 0) AS share_prev,
            coalesce({div('undefined_new - undefined_prev', 'undefined_prev')}, 'inf'::DOUBLE) AS mom,
            CASE WHEN share_new > 0.15 THEN 'ALERT' WHEN mom > 0.3 THEN 'WARNING' ELSE 'OK' END AS status FROM t""",
    ),
]


def _moved(dim):
    return f"""SELECT {dim}, coalesce(sum(sales) FILTER (time = '{PREV}'), 0)::DOUBLE AS prev, coalesce(sum(sales) FILTER (time = '{NEW}'), 0)::DOUBLE AS new
      FROM sales WHERE time IN ('{PREV}', '{NEW}') GROUP BY ALL"""


DRIFT = (
    "drift",
    f"""SELECT *, {div('new - prev', 'prev')} AS mom, CASE WHEN mom < -0.6 THEN 'ALERT' WHEN mom < -0.3 THEN 'WARNING' WHEN mom > 0.6 THEN 'SPIKE' ELSE 'OK' END AS status
        FROM ({_moved('brand')}) WHERE brand NOT IN {FUZZY_SQL} AND prev >= 100000""",
)
DEBUT = (
    "debut",
    f"""SELECT brand, sum(sales)::DOUBLE AS sales, {div('sum(sales)', f"(SELECT sum(sales) FROM sales WHERE time = '{NEW}')")} AS share FROM sales
        WHERE time = '{NEW}' AND brand NOT IN (SELECT brand FROM sales WHERE time <> '{NEW}') GROUP BY brand""",
)


@query("mon1_undefined", ctes(*SPIKE) + f"SELECT * REPLACE ({r('share_new')} AS share_new, {r('share_prev')} AS share_prev, {r('mom')} AS mom) FROM spike")
def mon1_undefined(spark, sf):
    out = market.undefined_spike(sales(spark, sf), NEW, PREV)
    return out.withColumns({c: F.bround(c, 6) for c in ("share_new", "share_prev", "mom")})


@query("mon2_debut", ctes(sales_cte(True), DEBUT) + f"SELECT brand, sales, {r('share')} AS share FROM debut")
def mon2_debut(spark, sf):
    return market.brand_debut(sales(spark, sf, fine=True), NEW).withColumn("share", F.bround("share", 6))


@query("mon3_drift", ctes(sales_cte(), DRIFT) + f"SELECT * REPLACE ({r('mom')} AS mom) FROM drift")
def mon3_drift(spark, sf):
    return market.brand_drift(sales(spark, sf), NEW, PREV, 100_000).withColumn("mom", F.bround("mom", 6))


@query(
    "mon4_platform",
    ctes(sales_cte())
    + f"""SELECT *, {r(div('new - prev', 'prev'))} AS mom FROM ({_moved('platform')} UNION ALL {_moved("'ALL'")})""",
)
def mon4_platform(spark, sf):
    return market.platform_mom(sales(spark, sf), NEW, PREV).withColumn("mom", F.bround("mom", 6))


@query(
    "mon5_summary",
    ctes(*[(n, s) for n, s in [sales_cte(True), *SPIKE[1:], DRIFT, DEBUT]])
    + f"""SELECT 'undefined' AS "check", status, 'Undefined' AS item, {r('share_new')} AS value FROM spike WHERE status <> 'OK'
      UNION ALL SELECT 'debut', 'NEW', brand, {r('share')} FROM debut UNION ALL SELECT 'drift', status, brand, {r('mom')} FROM drift WHERE status <> 'OK'""",
)
def mon5_summary(spark, sf):
    return market.monitor_summary(sales(spark, sf, fine=True), NEW, PREV, min_revenue=100_000).withColumn("value", F.bround("value", 6))


# data checks -----------------------------------------------------------------------------


@query(
    "dq1_volume",
    """WITH n AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n_rows FROM orders GROUP BY 1),
       e AS (SELECT strftime(l_shipdate, '%Y-%m') AS period, count(*) // 4 AS expected FROM lineitem GROUP BY 1)
       SELECT period, coalesce(n_rows, 0) AS n_rows, expected, """
    + r(div("coalesce(n_rows, 0) - expected", "expected")) + " AS gap, coalesce(abs(" + div("coalesce(n_rows, 0) - expected", "expected") + ") <= 0.2, false) AS ok FROM n FULL JOIN e USING (period)",
)
def dq1_volume(spark, sf):
    expected = table(spark, sf, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("period")).agg(F.floor(F.count("*") / 4).alias("expected"))
    out = quality.volume_check(table(spark, sf, "orders"), F.date_format("o_orderdate", "yyyy-MM"), expected)
    return out.withColumn("gap", F.bround("gap", 6))


@query(
    "dq2_ids",
    """SELECT sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (k IS NULL), 0)::BIGINT AS missing_ids, coalesce(sum(n - 1) FILTER (k IS NOT NULL), 0)::BIGINT AS duplicate_rows
       FROM (SELECT nullif(l_orderkey % 1000, 7) AS k, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def dq2_ids(spark, sf):
    return quality.id_check(table(spark, sf, "lineitem").select(F.nullif(F.col("l_orderkey") % 1000, F.lit(7)).alias("k")), "k")


PROFILED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "dq3_profile",
    ctes(
        ("long", " UNION ALL ".join(f"SELECT '{c}' AS col, CASE WHEN l_quantity <> 3 THEN {c} END AS v FROM lineitem" for c in PROFILED)),
        ("q", "SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1"),
    )
    + f"""SELECT col AS "column", count(*) AS n_rows, {r(div('count(*) FILTER (v IS NULL)', 'count(*)'))} AS null_rate, {r('max(q1)', 4)} AS q1, {r('max(q3)', 4)} AS q3,
      count(*) FILTER (v < q1 - 0.5 * (q3 - q1) OR v > q3 + 0.5 * (q3 - q1)) AS outliers FROM long JOIN q USING (col) GROUP BY col""",
)
def dq3_profile(spark, sf):
    df = table(spark, sf, "lineitem")
    df = df.select(*[F.when(F.col("l_quantity") != 3, F.col(c)).alias(c) for c in PROFILED])
    out = quality.profile_nulls_outliers(df, PROFILED, 0.5)
    return out.withColumns({"null_rate": F.bround("null_rate", 6), "q1": F.bround("q1", 4), "q3": F.bround("q3", 4)})


@query(
    "dq4_agg_detail",
    """WITH d AS (SELECT l_orderkey AS k, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS after FROM lineitem GROUP BY 1)
       SELECT coalesce(o_orderkey, k) AS order_id, coalesce(o_totalprice, 0) AS before, coalesce(after, 0) AS after,
       abs(coalesce(o_totalprice, 0) - coalesce(after, 0)) <= 50000 AS ok FROM orders FULL JOIN d ON o_orderkey = k""",
)
def dq4_agg_detail(spark, sf):
    money = lambda c: F.col(c).cast("decimal(18,2)").alias("amount")
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), money("o_totalprice"))
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), money("l_extendedprice"))
    return quality.agg_vs_detail(a, d, ["order_id"], "amount", 50_000)


@query("dq5_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 50")
def dq5_sample(spark, sf):
    return quality.spot_sample(table(spark, sf, "orders"), ["o_orderkey"], 50).select("o_orderkey", "o_custkey")


# search ----------------------------------------------------------------------------------


def search_docs(spark, sf):
    """One response document per product: the item, its repeat and an item without id."""
    def item(id_col, name):
        return F.struct(F.struct(id_col.alias("itemid"), F.col("p_size").cast("bigint").alias("shopid"), name.alias("name"),
                                 F.nullif("p_brand", F.lit("Brand#3")).alias("brand"), F.lit("img").alias("image"),
                                 F.floor(F.col("p_retailprice") * 100000).alias("price")).alias("item_basic"))

    items = F.array(item(F.col("p_partkey"), F.col("p_name")), item(F.col("p_partkey"), F.lit("zz")), item(F.lit(None).cast("bigint"), F.col("p_name")))
    key = F.concat(F.lit("  "), F.lower("p_type"), F.lit("   FOR Men "))
    return table(spark, sf, "part").select(F.to_json(F.create_map(key, F.struct(items.alias("items")))).alias("value"))


def search_facts(spark, sf):
    day = F.add_months(F.lit("2026-01-15").cast("date"), (F.col("shopid") % 3).cast("int"))
    return parse_search(search_items(search_docs(spark, sf)), day)


FACTS = (
    "facts",
    """SELECT (DATE '2026-01-15' + to_months((p_size % 3)::INT))::DATE AS created_at, upper(p_type[1]) || lower(p_type[2:]) || ' for men' AS key_word,
       '1__' || p_partkey || '__' || p_size AS product_base_id, p_name AS product_name, 'https://shopee.vn/product/' || p_size || '/' || p_partkey AS url,
       CASE WHEN p_brand = 'Brand#3' THEN '' ELSE p_brand END AS brand, 'img' AS url_thumbnail, 1::INT AS position FROM part WHERE p_partkey <> 0 AND p_size <> 0""",
)
SHARES = [
    FACTS,
    (
        "shares",
        """SELECT *, sum(products) OVER (PARTITION BY key_word)::BIGINT AS total FROM
           (SELECT key_word, coalesce(nullif(brand, ''), 'No Brand') AS brand, count(DISTINCT product_base_id) AS products FROM facts GROUP BY ALL)""",
    ),
]


@query("ss1_parse", ctes(FACTS) + "SELECT * FROM facts")
def ss1_parse(spark, sf):
    return search_facts(spark, sf)


@query(
    "ss2_share",
    ctes(
        *SHARES,
        ("top", "SELECT * FROM shares QUALIFY row_number() OVER (PARTITION BY key_word ORDER BY products DESC, brand) <= 3"),
        ("rest", "SELECT key_word, 'Others' AS brand, (max(total) - sum(products))::BIGINT AS products, max(total) AS total FROM top GROUP BY 1"),
    )
    + f"SELECT *, {r(div('products', 'total'))} AS share FROM (SELECT key_word, brand, products, total FROM top UNION ALL SELECT * FROM rest WHERE products > 0)",
)
def ss2_share(spark, sf):
    return search.search_share(search_facts(spark, sf)).withColumn("share", F.bround("share", 6))


@query(
    "ss3_trend",
    ctes(
        FACTS,
        (
            "s",
            """SELECT strftime(created_at, '%Y-%m') AS period, key_word, coalesce(nullif(brand, ''), 'No Brand') AS brand, count(DISTINCT product_base_id) AS products FROM facts GROUP BY ALL""",
        ),
        ("t", f"SELECT *, sum(products) OVER (PARTITION BY period, key_word)::BIGINT AS total, {div('products', 'sum(products) OVER (PARTITION BY period, key_word)')} AS share FROM s"),
        ("l", "SELECT *, lag(share) OVER (PARTITION BY key_word, brand ORDER BY period) AS prev_share FROM t"),
    )
    + f"SELECT period, key_word, brand, products, total, {r('share')} AS share, {r('prev_share')} AS prev_share, {r('share - prev_share')} AS change FROM l",
)
def ss3_trend(spark, sf):
    out = search.search_share_trend(search_facts(spark, sf), F.date_format("created_at", "yyyy-MM"))
    return out.withColumns({c: F.bround(c, 6) for c in ("share", "prev_share", "change")})


@query(
    "ss3_months",
    ctes(
        FACTS,
        ("named", "SELECT date_trunc('month', created_at)::DATE AS month, key_word, coalesce(nullif(brand, ''), 'No Brand') AS brand, product_base_id FROM facts"),
        ("span", "SELECT key_word, min(month) AS a, max(month) AS b FROM named GROUP BY 1"),
        ("grid", "SELECT DISTINCT key_word, brand, unnest(generate_series(a, b, INTERVAL 1 MONTH))::DATE AS month FROM named JOIN span USING (key_word)"),
        ("s", "SELECT g.month, g.key_word, g.brand, count(DISTINCT product_base_id) AS products FROM grid g LEFT JOIN named USING (month, key_word, brand) GROUP BY ALL"),
        ("t", f"SELECT *, sum(products) OVER (PARTITION BY month, key_word)::BIGINT AS total, {div('products', 'sum(products) OVER (PARTITION BY month, key_word)')} AS share FROM s"),
        ("l", "SELECT *, lag(share) OVER (PARTITION BY key_word, brand ORDER BY month) AS prev_share FROM t"),
    )
    + f"SELECT month, key_word, brand, products, total, {r('share')} AS share, {r('prev_share')} AS prev_share, {r('share - prev_share')} AS change FROM l",
)
def ss3_months(spark, sf):
    out = search.search_share_months(search_facts(spark, sf), F.col("created_at"))
    return out.withColumns({c: F.bround(c, 6) for c in ("share", "prev_share", "change")})


@query(
    "ss4_rank",
    f"""SELECT p_type AS key_word, p_brand AS brand, min(k)::BIGINT AS best_position, {r(div('sum(k)', 'count(*)'))} AS avg_position, count(*) AS items FROM
        (SELECT p_type, p_brand, rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS k FROM part) GROUP BY ALL""",
)
def ss4_rank(spark, sf):
    items = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("key_word"), F.col("p_brand").alias("brand"), "p_retailprice")
    placed = search.position_by(items, ["p_partkey"], F.col("p_retailprice"))
    return search.search_rank(placed).withColumn("avg_position", F.bround("avg_position", 6))


@query(
    "ss5_gaps",
    ctes(
        *SHARES,
        ("lead", "SELECT * FROM shares QUALIFY row_number() OVER (PARTITION BY key_word ORDER BY products DESC, brand) = 1"),
        ("own", "SELECT key_word, products FROM shares WHERE brand = 'Brand#7'"),
    )
    + f"""SELECT key_word, brand AS leader, {r(div('l.products', 'total'))} AS leader_share, {r(div('coalesce(o.products, 0)', 'total'))} AS own_share,
      {r(div('l.products', 'total') + ' - ' + div('coalesce(o.products, 0)', 'total'))} AS gap FROM lead l LEFT JOIN own o USING (key_word) WHERE brand <> 'Brand#7'""",
)
def ss5_gaps(spark, sf):
    out = search.keyword_gaps(search_facts(spark, sf), "Brand#7")
    return out.withColumns({c: F.bround(c, 6) for c in ("leader_share", "own_share", "gap")})


@query(
    "ss6_sponsored",
    ctes(FACTS)
    + f"""SELECT key_word, coalesce(nullif(brand, ''), 'No Brand') AS brand, count(*) AS items, count(*) FILTER (contains(product_name, 'red')) AS sponsored,
      {r(div("count(*) FILTER (contains(product_name, 'red'))", 'count(*)'))} AS sponsored_share FROM facts GROUP BY ALL""",
)
def ss6_sponsored(spark, sf):
    facts = search_facts(spark, sf).withColumn("is_ad", F.col("product_name").contains("red"))
    return search.sponsored_share(facts).withColumn("sponsored_share", F.bround("sponsored_share", 6))
