"""Keys, codes, missing values, columns."""

from pyspark.sql import functions as F

from quadrat.functions import keys as K, missing as M, text as X
from quadrat.operators import groups as G, merge as J, reshape as R
from quadrat.queries.registry import Tables, query


@query("key_pad_compose", """
    SELECT c_custkey,
           CASE WHEN length(c_nationkey::VARCHAR) < 2 THEN lpad(c_nationkey::VARCHAR, 2, '0') ELSE c_nationkey::VARCHAR END AS nation,
           CASE WHEN length(c_custkey::VARCHAR) < 3 THEN lpad(c_custkey::VARCHAR, 3, '0') ELSE c_custkey::VARCHAR END AS local,
           CASE WHEN length(c_nationkey::VARCHAR) < 2 THEN lpad(c_nationkey::VARCHAR, 2, '0') ELSE c_nationkey::VARCHAR END
             || CASE WHEN length(c_custkey::VARCHAR) < 3 THEN lpad(c_custkey::VARCHAR, 3, '0') ELSE c_custkey::VARCHAR END AS fips,
           substr(c_nationkey::VARCHAR || '_' || c_custkey::VARCHAR, 1, 20) AS person
    FROM customer
""")
def key_pad_compose(t: Tables):
    """Padded codes; values longer than the pad stay whole."""
    return (
        t.customer.select(
            "c_custkey", K.zero_pad(F.col("c_nationkey").cast("double"), 2).alias("nation"),
            K.zero_pad("c_custkey", 3).alias("local"),
            F.substring(K.compose_key("c_nationkey", "c_custkey", sep="_"), 1, 20).alias("person"),
        ).withColumn("fips", K.compose_key("nation", "local"))
    )


@query("number_parse", """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN NULL
                ELSE TRY_CAST(replace(format('{:,.2f}', o_totalprice), ',', '') AS DOUBLE) END AS price,
           TRY_CAST(o_orderpriority AS BIGINT) AS priority_number,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_rank
    FROM orders
""")
def number_parse(t: Tables):
    """Formatted numbers back to numbers; ``.`` and unparsable text are missing."""
    shown = F.when(F.col("o_orderstatus") == "F", ".").otherwise(F.format_number("o_totalprice", 2))
    return t.orders.select(
        "o_orderkey", K.number_from_text(shown, "double", blank_mark=".").alias("price"),
        K.number_from_text("o_orderpriority").alias("priority_number"),
        K.number_from_text(F.substring("o_orderpriority", 1, 1)).alias("priority_rank"),
    )


@query("title_case", """
    SELECT p_partkey,
           array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS name,
           upper(p_type[1]) || lower(p_type[2:]) || '-' || upper(p_brand[1]) || lower(p_brand[2:]) AS label,
           string_split(p_brand, '#')[2] AS brand_no, substr(p_type, 1, 2) AS type_head
    FROM part
""")
def title_case(t: Tables):
    return t.part.select(
        "p_partkey", K.title_case("p_name").alias("name"),
        K.title_case(F.concat_ws("-", "p_type", F.lower("p_brand"))).alias("label"),
        K.take_part("p_brand", "#", 1).alias("brand_no"), F.substring("p_type", 1, 2).alias("type_head"),
    )


# Balance band -> age-like category (fixed values of the query).
_BANDS = {0: 0, 1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2, 7: 3, 8: 3, 9: 3, 10: 3}


@query("age_recode_share", """
    WITH b AS (
      SELECT c_nationkey, CAST(floor((c_acctbal + 1000) / 1000) AS INTEGER) AS band FROM customer),
    c AS (
      SELECT c_nationkey, CASE WHEN band = 0 THEN 'low' WHEN band <= 3 THEN 'young' WHEN band <= 6 THEN 'middle' ELSE 'old' END AS cat,
             CASE WHEN band >= 8 THEN 61 WHEN band >= 5 THEN 26 WHEN band >= 2 THEN 15 END AS code FROM b)
    SELECT c_nationkey,
           count(*) FILTER (cat = 'young') AS young, count(*) FILTER (cat = 'middle') AS middle, count(*) FILTER (cat = 'old') AS old,
           count(*) FILTER (code = 61) AS top_code,
           round(count(*) FILTER (cat = 'young') * 100.0 / count(*), 6) AS young_pct,
           round(count(*) FILTER (cat = 'middle') * 100.0 / count(*), 6) AS middle_pct
    FROM c GROUP BY c_nationkey
""")
def age_recode_share(t: Tables):
    """Dictionary recode, hard ranges, pivoted counts and shares."""
    names = {0: "low", 1: "young", 2: "middle", 3: "old"}
    coded = t.customer.select(
        "c_nationkey", F.floor((F.col("c_acctbal") + 1000) / 1000).cast("int").alias("band")
    ).withColumn("cat", K.recode(K.recode("band", _BANDS, strict=True), names)).withColumn(
        "code", K.range_code("band", [(2, 4, 15), (5, 7, 26), (8, None, 61)]))
    counts = coded.groupBy("c_nationkey", "cat").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("code") == 61).cast("int")).alias("top"))
    wide = R.fill_zero(R.to_wide(counts, ["c_nationkey"], "cat", ["n", "top"], list(names.values())), "")
    total = F.col("nlow") + F.col("nyoung") + F.col("nmiddle") + F.col("nold")
    return wide.select(
        "c_nationkey", F.col("nyoung").alias("young"), F.col("nmiddle").alias("middle"), F.col("nold").alias("old"),
        (F.col("toplow") + F.col("topyoung") + F.col("topmiddle") + F.col("topold")).alias("top_code"),
        F.round(F.col("nyoung") * 100.0 / total, 6).alias("young_pct"),
        F.round(F.col("nmiddle") * 100.0 / total, 6).alias("middle_pct"),
    )


@query("entity_merge_counts", """
    WITH m AS (
      SELECT CASE WHEN c_nationkey IN (3, 6) THEN '261' ELSE lpad(c_nationkey::VARCHAR, 3, '0') END AS fips,
             count(*) AS n, count(*) FILTER (c_acctbal < 0) AS debt
      FROM customer GROUP BY 1)
    SELECT fips, n, debt, round(debt * 100.0 / n, 6) AS debt_pct FROM m
""")
def entity_merge_counts(t: Tables):
    """Two entities become one on counts, shares come after."""
    counts = t.customer.groupBy(K.zero_pad("c_nationkey", 3).alias("fips")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("c_acctbal") < 0).cast("int")).alias("debt"))
    merged = G.merge_entities(counts, "fips", ["003", "006"], "261", ["n", "debt"])
    return merged.withColumn("debt_pct", F.round(F.try_divide(F.col("debt") * 100.0, F.col("n")), 6))


@query("sentinel_missing", """
    WITH v AS (
      SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
             CASE WHEN value < 10 THEN -100.0 WHEN value < 20 THEN -5.0 ELSE value END AS coded,
             CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'view' THEN 0 END AS bought FROM events)
    SELECT event_id, event_type, CASE WHEN coded = -100 THEN 0.0 WHEN coded < 0 THEN NULL ELSE coded END AS spent,
           CASE WHEN coded < 0 THEN 0.0 ELSE coded END AS clamped,
           CASE WHEN coded IN (-100, -5) THEN NULL ELSE coded END AS known, bought
    FROM v
""")
def sentinel_missing(t: Tables):
    coded = F.when(F.col("value") < 10, -100.0).when(F.col("value") < 20, -5.0).otherwise(F.col("value"))
    answer = F.when(F.col("event_type") == "purchase", "Y").when(F.col("event_type") == "view", "N").otherwise("DK")
    rows = t.events.select("event_id", "event_type", coded.alias("coded"), coded.alias("known"), answer.alias("answer"))
    rows = M.recode_sentinel_strings(rows, ["error"], subset=["event_type"])
    rows = M.recode_sentinel_numbers(rows, [-100, -5], subset=["known"])
    return rows.select(
        "event_id", "event_type", M.zero_then_missing("coded").alias("spent"), M.clamp_negative("coded").alias("clamped"),
        "known", M.yes_no("answer").alias("bought"),
    )


@query("indicator_flags", """
    WITH o AS (SELECT *, nullif(o_orderstatus, 'P') AS src FROM orders)
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 1 WHEN src IS NOT NULL THEN 0 END AS urgent,
           CASE WHEN src = 'O' THEN 1 ELSE 0 END AS open,
           CASE WHEN src IS NOT NULL THEN (o_totalprice > 100000)::INTEGER END AS big
    FROM o WHERE src IS NOT NULL AND year(o_orderdate) <= 1998 AND src IS DISTINCT FROM 'F'
       OR src IS NULL AND year(o_orderdate) <= 1998
""")
def indicator_flags(t: Tables):
    """Indicators that are missing with their source, or zero otherwise."""
    rows = t.orders.withColumn("src", F.nullif("o_orderstatus", F.lit("P")))
    kept = M.keep_when(rows, M.known_year_and_type(F.year("o_orderdate"), 1998, "src", "F"))
    return kept.select(
        "o_orderkey", M.flag(F.col("o_orderpriority") == "1-URGENT", F.col("src").isNotNull()).alias("urgent"),
        M.flag(F.col("src") == "O").alias("open"), M.dummy(F.col("o_totalprice") > 100000, "src").alias("big"),
    )


@query("missing_as_largest", """
    WITH v AS (SELECT event_id, CASE WHEN value < 10 THEN NULL ELSE value END AS v, nullif(event_type, 'error') AS kind FROM events)
    SELECT event_id, (v IS NULL OR v > 100)::INTEGER AS above, (v IS NOT NULL AND v <= 100)::INTEGER AS upto,
           (kind IS DISTINCT FROM 'click')::INTEGER AS not_click,
           CASE WHEN kind IN ('click', 'view') THEN kind ELSE 'Other' END AS kind3,
           CASE WHEN kind IS DISTINCT FROM 'purchase' THEN NULL ELSE v END AS spent
    FROM v WHERE v IS NULL OR v >= 15
""")
def missing_as_largest(t: Tables):
    rows = t.events.select("event_id", F.when(F.col("value") >= 10, F.col("value")).alias("v"),
                           F.nullif("event_type", F.lit("error")).alias("kind"))
    return M.keep_when(rows, M.ge_m("v", 15)).select(
        "event_id", M.gt_m("v", 100).cast("int").alias("above"), M.le_m("v", 100).cast("int").alias("upto"),
        M.ne_m("kind", "click").cast("int").alias("not_click"),
        K.keep_categories("kind", ["click", "view"], "Other").alias("kind3"),
        M.overwrite_when("v", M.ne_m("kind", "purchase")).alias("spent"),
    )


@query("onehot_encode", """
    SELECT o_orderkey, (o_orderpriority = '1-URGENT')::INTEGER AS p1, (o_orderpriority = '2-HIGH')::INTEGER AS p2,
           (o_orderpriority = '3-MEDIUM')::INTEGER AS p3, (o_orderpriority = '4-NOT SPECIFIED')::INTEGER AS p4,
           (o_orderpriority = '5-LOW')::INTEGER AS p5,
           dense_rank() OVER (ORDER BY o_orderstatus)::BIGINT AS status_code,
           dense_rank() OVER (ORDER BY o_orderstatus, o_orderpriority)::BIGINT AS group_code,
           CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS ordered_status
    FROM orders
""")
def onehot_encode(t: Tables):
    """Dummies, alphabetical codes, group ids and label codes."""
    rows = K.one_hot(t.orders, "o_orderpriority", "p")
    rows = K.group_id(K.encode_sorted(rows, "o_orderstatus", "status_code"), ["o_orderstatus", "o_orderpriority"], "group_code")
    return rows.select(
        "o_orderkey", "p1", "p2", "p3", "p4", "p5", "status_code", "group_code",
        K.label_codes("o_orderstatus", {1: "O", 2: "P"}).alias("ordered_status"),
    )


@query("column_ops", """
    SELECT c_custkey AS hh_custkey, 'base' AS wave, 7 AS round, c_name AS hh_name, n_name AS hh_nation,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS hh_acctbal, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS hh_mktsegment
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE starts_with(c_mktsegment, 'MA') OR n_name IN ('NATION_1', 'NATION_2') OR contains(c_name, '77')
""")
def column_ops(t: Tables):
    """Wildcard selection, prefix rename, constants at a position, predicates."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.filter(
        M.has_prefix("c_mktsegment", "MA") | F.col("n_name").isin("NATION_1", "NATION_2") | M.mentions("c_name", "77"))
    rows = rows.drop("n_regionkey").withColumnsRenamed({"n_name": "c_nation"})
    rows = rows.select("c_custkey", *[c for c in R.columns_like(rows, "c_n*", "c_a*", "c_m*") if c != "c_nationkey"])
    known = F.col("c_acctbal") >= 0
    rows = rows.withColumns({c: F.when(known, F.col(c)) for c in ("c_acctbal", "c_mktsegment")})
    rows = rows.withColumnsRenamed({c: c[2:] for c in rows.columns})
    rows = R.rename_prefixed(M.drop_all_missing(rows), rows.columns, "hh_")
    return R.insert_constants(rows, 1, wave="base", round=7)


@query("last_token", """
    WITH p AS (
      SELECT p_partkey, p_type || ' - ' || p_name AS kind, (floor(p_retailprice / 100) * 100)::BIGINT AS low FROM part)
    SELECT p_partkey, regexp_extract(kind, '([^- ]+)$', 1) AS token,
           CASE WHEN low >= 1500 THEN 1500.0 ELSE low + 100.0 END::DOUBLE AS ceiling, low::DOUBLE / 100 * 100 AS rescaled
    FROM p
""")
def last_token(t: Tables):
    """Upper end of labelled intervals with open-ended labels."""
    low = (F.floor(F.col("p_retailprice") / 100) * 100).cast("bigint")
    label = F.when(low >= 1500, ">1500").otherwise(F.concat_ws(" - ", low.cast("string"), (low + 100).cast("string")))
    return t.part.select(
        "p_partkey", K.last_token(F.concat_ws(" - ", "p_type", "p_name")).alias("token"),
        K.interval_ceiling(label, {">1500": "1500"}).alias("ceiling"), (low.cast("double") / 100 * 100).alias("rescaled"),
    )


@query("query_string", """
    SELECT o_orderkey, 'Tx_Commodity=' || o_custkey || '&Tx_State=' || o_orderpriority[1] || '&DateFrom=' || strftime(o_orderdate, '%d-%b-%Y')
           || '&Tx_StateHead=' || replace(o_orderpriority, ' ', '+') || '&Tx_DistrictHead=--Select--' AS query
    FROM orders
""")
def query_string(t: Tables):
    return t.orders.select("o_orderkey", X.query_string({
        "Tx_Commodity": "o_custkey", "Tx_State": F.substring("o_orderpriority", 1, 1),
        "DateFrom": X.reformat_date(F.date_format("o_orderdate", "dd-MM-yyyy")),
        "Tx_StateHead": "o_orderpriority", "Tx_DistrictHead": F.lit("--Select--"),
    }).alias("query"))


@query("date_reformat", """
    SELECT o_orderkey, strftime(o_orderdate, '%d-%b-%Y') AS shown, o_orderdate::DATE AS day, month(o_orderdate)::INTEGER AS month FROM orders
""")
def date_reformat(t: Tables):
    text = F.date_format("o_orderdate", "dd-MM-yyyy")
    return t.orders.select(
        "o_orderkey", X.reformat_date(text).alias("shown"), F.to_date(text, "dd-MM-yyyy").alias("day"),
        F.month("o_orderdate").alias("month"))


@query("duplicates_distinct", """
    SELECT l_returnflag, l_linestatus, round(l_discount + 0.0, 2) AS discount, count(*) AS freq FROM
      (SELECT DISTINCT l_returnflag, l_linestatus, l_discount + 0.0 AS l_discount, l_partkey FROM lineitem) GROUP BY ALL
""")
def duplicates_distinct(t: Tables):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", F.round(F.col("l_discount") + 0.0, 2).alias("discount"), "l_partkey")
    return G.counts_by(rows.distinct(), ["l_returnflag", "l_linestatus", "discount"], out="freq")


@query("frequency_labels", """
    SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' END AS label, count(*) AS freq
    FROM orders GROUP BY 1
""")
def frequency_labels(t: Tables):
    freq = K.set_label(G.frequencies(t.orders, "o_orderstatus"), {"freq": "Frequency"})
    return freq.select("o_orderstatus", K.recode("o_orderstatus", {"F": "Filled", "O": "Open"}).alias("label"), "freq").orderBy("o_orderstatus")


@query("panel_check", """
    SELECT user_id, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1
""")
def panel_check(t: Tables):
    """Panel keys that are not unique."""
    rows = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"))
    return J.duplicate_keys(rows, ["user_id", "hour"])
