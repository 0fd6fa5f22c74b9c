"""Single operators on the supplied tables: quality, privacy, joins, aggregates, windows, text scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queries.common import DOMAIN, add, mean, quotient
from tallymark.functions import aggregates as agg
from tallymark.functions import conditional as cond
from tallymark.functions import formulas, privacy
from tallymark.operators import joins, kpi, registry, textscan, windows
from tallymark.operators import quality as dq

AS_OF = "2001-11-04"
EVENTS_AS_OF = "2024-01-30"

# Quality gates and deduplication. Errors play the deleted versions of a user.
DOMAIN["event_versions"] = """
    SELECT user_id, event_id, ts AS data_load_ts, value,
           CASE event_type WHEN 'error' THEN 'DELETED' WHEN 'signup' THEN NULL ELSE event_type END AS record_status,
           CASE WHEN value < 2 THEN 'FAIL' WHEN value < 10 THEN NULL ELSE 'PASS' END AS data_quality_flag,
           CASE WHEN value < 20 THEN NULL ELSE props END AS payload, 'raw' AS raw_payload,
           CAST(event_id AS STRING) AS ingestion_batch_id
    FROM {events}"""
_VERSION_OUT = "user_id:l event_id:l value:d record_status:s data_quality_flag:s"
_LATEST = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
    ORDER BY data_load_ts DESC, event_id DESC) AS rn FROM {source}) WHERE rn = 1"""


def _latest(df: DataFrame) -> DataFrame:
    return windows.dedupe_latest(df, ["user_id"], tie_breakers=["event_id"])


add("drop_deleted", dq.drop_deleted, "event_versions", _VERSION_OUT,
    "SELECT * FROM event_versions WHERE record_status <> 'DELETED'")
add("dq_gate", dq.dq_gate, "event_versions", _VERSION_OUT,
    """SELECT * FROM event_versions WHERE record_status <> 'DELETED'
       AND (data_quality_flag IS NULL OR data_quality_flag <> 'FAIL')""")  # fmt: skip
add("dedupe_latest", _latest, "event_versions", _VERSION_OUT, _LATEST.format(source="event_versions"))
add("dedupe_after_gate", lambda df: _latest(dq.drop_deleted(df)), "event_versions", _VERSION_OUT,
    _LATEST.format(source="(SELECT * FROM event_versions WHERE record_status <> 'DELETED')"))
add("dedupe_before_gate", lambda df: dq.drop_deleted(_latest(df)), "event_versions", _VERSION_OUT,
    f"SELECT * FROM ({_LATEST.format(source='event_versions')}) WHERE record_status <> 'DELETED'")
add("quarantine_good", lambda df: dq.split_quarantine(df, ["payload", "record_status"], EVENTS_AS_OF)[0],
    "event_versions", _VERSION_OUT,
    "SELECT * FROM event_versions WHERE payload IS NOT NULL AND record_status IS NOT NULL")
add("quarantine_bad", lambda df: dq.split_quarantine(df, ["payload", "record_status"], EVENTS_AS_OF)[1],
    "event_versions", f"{_VERSION_OUT} quarantine_reason:s quarantine_ts:t",
    f"""SELECT *, 'failed_not_null_dq_check' AS quarantine_reason, TIMESTAMP '{EVENTS_AS_OF} 00:00:00' AS quarantine_ts
        FROM event_versions WHERE payload IS NULL OR record_status IS NULL""")  # fmt: skip
add("add_audit", lambda df: dq.add_audit(df, EVENTS_AS_OF), "event_versions",
    "event_id:l silver_load_ts:t source_batch_id:s",
    f"""SELECT event_id, TIMESTAMP '{EVENTS_AS_OF} 00:00:00' AS silver_load_ts,
        ingestion_batch_id AS source_batch_id FROM event_versions""")  # fmt: skip
add("base_clean", lambda df: dq.base_clean(df, "events_bronze", EVENTS_AS_OF), "event_versions",
    "event_id:l value:d _silver_load_ts:t _source_bronze_table:s",
    f"""SELECT event_id, value, TIMESTAMP '{EVENTS_AS_OF} 00:00:00' AS _silver_load_ts,
        'events_bronze' AS _source_bronze_table FROM event_versions
        WHERE record_status <> 'DELETED' AND (data_quality_flag IS NULL OR data_quality_flag <> 'FAIL')""")  # fmt: skip
add("complementary_split", lambda df: kpi.kpis(
        df.withColumn("side", F.when(F.col("value") >= 50, "high").otherwise("low")),
        {"events": F.count(F.lit(1))}, by=["side"]),
    "events", "side:s events:l",
    "SELECT CASE WHEN value >= 50 THEN 'high' ELSE 'low' END AS side, COUNT(*) AS events FROM events GROUP BY 1")

# Conforming of values.
DOMAIN["raw_values"] = """
    SELECT event_id, ' ' || event_type || ' ' AS kind, value - 5 AS score,
           CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN '  ' WHEN 'error' THEN NULL ELSE ' ' || props END AS note,
           CASE event_type WHEN 'view' THEN 'u' || CAST(user_id AS STRING) || '@mail.example.com'
               WHEN 'click' THEN 'no-at.example.com' WHEN 'signup' THEN 'u@nodot' END AS email,
           CAST(ts AS DATE) AS day
    FROM {events}"""
add(
    "conform_values",
    lambda df: df.select(
        "event_id",
        dq.conform_enum("kind", ["VIEW", "CLICK"], dq.UNKNOWN).alias("kind"),
        dq.null_out_of_range("score").alias("score"),
        dq.blank_to_null("note").alias("note"),
        dq.valid_email("email").alias("email_valid"),
        dq.positive("score").alias("positive"),
        dq.set_and_not_zero("score").alias("not_zero"),
        dq.set_and_before("day", dq.as_of_date("2024-01-15")).alias("expired"),
        dq.set_and_within_days("day", dq.as_of_date("2024-01-15"), 5).alias("expiring"),
    ),
    "raw_values",
    "event_id:l kind:s score:d note:s email_valid:b positive:b not_zero:b expired:b expiring:b",
    """SELECT event_id, CASE WHEN UPPER(TRIM(kind)) IN ('VIEW', 'CLICK') THEN UPPER(TRIM(kind)) ELSE 'UNKNOWN' END AS kind,
       CASE WHEN score BETWEEN 0 AND 100 THEN score END AS score,
       CASE WHEN note = '' THEN NULL ELSE UPPER(TRIM(note)) END AS note,
       regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') AS email_valid,
       score IS NOT NULL AND score > 0 AS positive, score IS NOT NULL AND score <> 0 AS not_zero,
       day < DATE '2024-01-15' AS expired, DATE_DIFF('day', DATE '2024-01-15', day) <= 5 AS expiring FROM raw_values""",
)
add("key_violations", lambda df: dq.key_violations(df, ["l_orderkey", "l_linenumber"]), "lineitem",
    "l_orderkey:l l_linenumber:l row_count:l",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem GROUP BY ALL
       HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")  # fmt: skip
DOMAIN["customer_regions"] = """
    SELECT c_custkey, c_name, r_name AS region FROM {customer}
    JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""
add("row_filter", lambda df: dq.row_filter(df, "region", ["ASIA", "EUROPE"]), "customer_regions",
    "c_custkey:l c_name:s region:s", "SELECT * FROM customer_regions WHERE region IN ('ASIA', 'EUROPE')")

# Privacy.
DOMAIN["contacts"] = """
    SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'plain text'
               ELSE ' ' || c_name || '@Example.com' END AS email,
           CASE WHEN c_custkey < 100 THEN CAST(c_custkey AS STRING) ELSE '+1555' || CAST(c_custkey AS STRING) END AS phone,
           ' ' || c_name || ' ' AS name
    FROM {customer}"""
add(
    "mask_contacts",
    lambda df: df.select(
        "id",
        privacy.mask_email("email").alias("email_raw"),
        privacy.mask_email_normalised("email").alias("email_clean"),
        privacy.mask_phone("phone").alias("phone"),
        privacy.mask_id("name").alias("name_id"),
        privacy.hash_pii("name").alias("name_hash"),
    ),
    "contacts",
    "id:l email_raw:s email_clean:s phone:s name_id:s name_hash:s",
    """SELECT id, SUBSTRING(email, 1, 1) || '***@' || string_split(email, '@')[2] AS email_raw,
       SUBSTRING(string_split(LOWER(TRIM(email)), '@')[1], 1, 1) || '***@' || string_split(LOWER(TRIM(email)), '@')[2]
           AS email_clean, '******' || SUBSTRING(phone, -4, 4) AS phone, 'XXXXXXXX' || SUBSTRING(name, -4, 4) AS name_id,
       sha256(TRIM(name)) AS name_hash FROM contacts""",
)


def _matches(pattern: str) -> str:
    return "len(regexp_extract_all(text, '" + pattern.replace("'", "''") + "'))"


_SCAN = " UNION ALL ".join(
    f"SELECT doc_id, lang, '{name}' AS pattern, {_matches(regex)} AS hits FROM documents"
    for name, regex in textscan.PATTERNS.items()
)
_SCAN = f"SELECT * FROM ({_SCAN}) WHERE hits > 0"
LANGUAGES = ["de", "en", "es", "fr"]
add("scan_patterns", lambda df: textscan.scan_patterns(df, "text", ["doc_id", "lang"]), "documents",
    "doc_id:l lang:s pattern:s hits:l", _SCAN)
_NAMES = ", ".join(f"('{name}')" for name in textscan.PATTERNS)


def _matrix(source: str, groups: list[str], column: str) -> str:
    sums = [f"SUM(CASE WHEN {column} = '{g}' THEN hits ELSE 0 END) AS {g}" for g in groups]
    listed = ", ".join(f"'{g}'" for g in groups)
    sums.append(f"SUM(CASE WHEN {column} IN ({listed}) THEN 0 ELSE hits END) AS other")
    filled = ", ".join(f"COALESCE({g}, 0) AS {g}" for g in [*groups, "other"])
    return f"""SELECT pattern, {filled} FROM (VALUES {_NAMES}) names(pattern)
        LEFT JOIN (SELECT pattern, {", ".join(sums)} FROM ({source}) GROUP BY pattern) USING (pattern)"""


def _matrix_columns(groups: list[str]) -> str:
    return "pattern:s " + " ".join(f"{g}:l" for g in [*groups, "other"])


add("pattern_matrix",
    lambda df: textscan.pattern_matrix(textscan.scan_patterns(df, "text", ["lang"]), "lang", LANGUAGES),
    "documents", _matrix_columns(LANGUAGES), _matrix(_SCAN, LANGUAGES, "lang"))
# Documents of an unlisted language, and of none.
DOMAIN["odd_languages"] = "SELECT text, CASE lang WHEN 'de' THEN NULL ELSE lang END AS lang FROM {documents}"
_ODD_SCAN = " UNION ALL ".join(
    f"SELECT lang, '{name}' AS pattern, {_matches(regex)} AS hits FROM odd_languages"
    for name, regex in textscan.PATTERNS.items()
)
add("pattern_matrix_other",
    lambda df: textscan.pattern_matrix(textscan.scan_patterns(df, "text", ["lang"]), "lang", ["en", "es"]),
    "odd_languages", _matrix_columns(["en", "es"]), _matrix(_ODD_SCAN, ["en", "es"], "lang"))
add("scan_pages", lambda df: textscan.scan_patterns(df, "html", ["page_id"]), "pages", "page_id:l pattern:s hits:l",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT page_id, '{name}' AS pattern, {_matches(regex).replace('(text,', '(html,')} AS hits FROM pages"
        for name, regex in textscan.PATTERNS.items()) + ") WHERE hits > 0")
# Turns as a mail export has them, signed with the sender's address.
DOMAIN["signed_turns"] = """
    SELECT conv_id, turn, text || ' -- ' || role || CAST(conv_id AS STRING) || '@mail.example.com' AS text FROM {conversations}"""
add("scan_conversations", lambda df: textscan.scan_patterns(df, "text", ["conv_id", "turn"]), "signed_turns",
    "conv_id:l turn:l pattern:s hits:l",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT conv_id, turn, '{name}' AS pattern, {_matches(regex)} AS hits FROM signed_turns"
        for name, regex in textscan.PATTERNS.items()) + ") WHERE hits > 0")

# Registry rows with array columns.
add(
    "rule_coverage",
    lambda df: registry.coverage(
        df.select(
            F.col("o_orderpriority").alias("domain"),
            F.array((F.col("o_orderkey") % 24 + 1), (F.col("o_custkey") % 7 + 1), F.lit(4)).alias("selected_rules"),
        ),
        "domain", "selected_rules", "rule",
    ),
    "orders", "domain:s rule:l jobs:l",
    """SELECT o_orderpriority AS domain, rule, COUNT(*) AS jobs
       FROM (SELECT o_orderpriority, UNNEST([o_orderkey % 24 + 1, o_custkey % 7 + 1, 4]) AS rule FROM orders)
       GROUP BY ALL""",
)

# Joins.
DOMAIN["order_lines"] = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount,
           CAST(l_shipdate AS DATE) AS ship_date, l_returnflag
    FROM {lineitem}"""
DOMAIN["part_dim"] = "SELECT p_partkey AS l_partkey, p_brand, p_type FROM {part}"
DOMAIN["supplier_dim"] = "SELECT s_suppkey AS l_suppkey, s_name FROM {supplier}"
_KEYS = "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:l"
add("enrich_lines",
    lambda lines, parts, suppliers: joins.enrich(
        lines, [joins.Dim(parts, "l_partkey", ["p_brand"]), joins.Dim(suppliers, "l_suppkey")]),
    "order_lines part_dim supplier_dim", f"{_KEYS} p_brand:s s_name:s",
    """SELECT o.*, p_brand, s_name FROM order_lines o LEFT JOIN part_dim p ON o.l_partkey = p.l_partkey
       LEFT JOIN supplier_dim s ON o.l_suppkey = s.l_suppkey""")  # fmt: skip


def _never(side):
    return False


# Two rows per key on the side, NULL keys and one key with a third of the rows on the left, all joins by shuffle.
DOMAIN["hot_lines"] = """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 7 WHEN l_linenumber = 1 THEN NULL ELSE l_partkey END
           AS l_partkey, l_suppkey FROM {lineitem}"""
DOMAIN["part_prices"] = """
    SELECT p_partkey AS l_partkey, 'list' AS price_kind, p_brand FROM {part}
    UNION ALL SELECT p_partkey AS l_partkey, 'offer' AS price_kind, p_brand FROM {part} WHERE p_partkey % 2 = 1"""
DOMAIN["brand_names"] = """
    SELECT DISTINCT p_brand, 'brand of ' || p_brand AS brand_name FROM {part} UNION ALL SELECT DISTINCT p_brand, 'other name'
    FROM {part} WHERE p_brand = 'Brand#11' OR p_brand = 'Brand#23'"""
add("enrich_spread",
    lambda lines, prices, suppliers: joins.enrich(
        lines, [joins.Dim(prices.hint("merge"), "l_partkey"), joins.Dim(suppliers.hint("merge"), "l_suppkey")],
        small=_never),
    "hot_lines part_prices supplier_dim", f"{_KEYS} price_kind:s p_brand:s s_name:s",
    """SELECT o.*, price_kind, p_brand, s_name FROM hot_lines o LEFT JOIN part_prices p ON o.l_partkey = p.l_partkey
       LEFT JOIN supplier_dim s ON o.l_suppkey = s.l_suppkey""")  # fmt: skip
add("chain_spread",
    lambda lines, prices, brands: joins.left_chain(
        lines, "line",
        [joins.Step(prices.hint("merge"), "line.l_partkey", "price.l_partkey"),
         joins.Step(brands.hint("merge"), "price.p_brand", "brand.p_brand")],
        small=_never).select("line.l_orderkey", "line.l_linenumber", "line.l_partkey", "price.price_kind", "brand.brand_name"),
    "hot_lines part_prices brand_names", "l_orderkey:l l_linenumber:l l_partkey:l price_kind:s brand_name:s",
    """SELECT l_orderkey, l_linenumber, o.l_partkey, price_kind, brand_name FROM hot_lines o
       LEFT JOIN (part_prices p LEFT JOIN brand_names b ON p.p_brand = b.p_brand) ON o.l_partkey = p.l_partkey""")  # fmt: skip
add("broadcast_left", lambda lines, parts: joins.broadcast_left(lines, parts, "l_partkey"),
    "order_lines part_dim", f"{_KEYS} p_brand:s p_type:s",
    "SELECT o.*, p_brand, p_type FROM order_lines o LEFT JOIN part_dim p ON o.l_partkey = p.l_partkey")
DOMAIN["shipped_daily"] = """
    SELECT CASE WHEN l_suppkey = 3 THEN NULL ELSE l_suppkey END AS store, CAST(l_shipdate AS DATE) AS day,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
    FROM {lineitem}"""
DOMAIN["ordered_daily"] = """
    SELECT CASE WHEN o_custkey = 5 THEN NULL ELSE o_custkey END AS store, CAST(o_orderdate AS DATE) AS day,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS amount
    FROM {orders}"""
add("full_outer_nullsafe",
    lambda shipped, ordered: joins.full_outer_nullsafe(
        kpi.kpis(shipped, {"shipped": F.sum("amount")}, by=["store", "day"]),
        kpi.kpis(ordered, {"ordered": F.sum("amount")}, by=["store", "day"]), ["store", "day"], aggregated=True),
    "shipped_daily ordered_daily", "store:l day:D shipped:d ordered:d",
    """WITH a AS (SELECT store, day, SUM(amount) AS shipped FROM shipped_daily GROUP BY ALL),
       b AS (SELECT store, day, SUM(amount) AS ordered FROM ordered_daily GROUP BY ALL)
       SELECT COALESCE(a.store, b.store) AS store, COALESCE(a.day, b.day) AS day, shipped, ordered
       FROM a FULL OUTER JOIN b ON a.store IS NOT DISTINCT FROM b.store AND a.day IS NOT DISTINCT FROM b.day""")  # fmt: skip
# A third of the rows of both sides share one key, which matches, and another large one, which does not.
DOMAIN["hot_shipped"] = """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2) THEN NULL WHEN l_linenumber = 3 THEN -1 ELSE l_orderkey END AS k,
           CASE WHEN l_linenumber = 1 THEN 'x' WHEN l_linenumber = 2 THEN NULL ELSE l_linestatus END AS s
    FROM {lineitem}"""
DOMAIN["hot_ordered"] = """
    SELECT CASE WHEN o_orderkey = 1 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN -2 ELSE o_orderkey END AS kk,
           CASE WHEN o_orderkey = 1 THEN 'x' WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS s, o_orderkey
    FROM {orders}"""
add("full_outer_hot_key", lambda shipped, ordered: joins.full_outer_nullsafe(shipped, ordered, ["k", "s"], ["kk", "s"]),
    "hot_shipped hot_ordered", "k:l s:s l_orderkey:l l_linenumber:l o_orderkey:l",
    """SELECT COALESCE(k, kk) AS k, COALESCE(a.s, b.s) AS s, l_orderkey, l_linenumber, o_orderkey
       FROM hot_shipped a FULL OUTER JOIN hot_ordered b ON k IS NOT DISTINCT FROM kk AND a.s IS NOT DISTINCT FROM b.s""")  # fmt: skip
add("join_aggregates",
    lambda customers, orders: joins.join_aggregates(
        customers.select(F.col("c_custkey").alias("key"), "c_mktsegment"), "key",
        [kpi.kpis(orders.withColumn("key", F.col("o_custkey")).filter(F.col("o_orderstatus") == status),
                  {f"orders_{status}": F.count(F.lit(1))}, by=["key"]) for status in "FO"],
        {"orders_F": 0, "orders_O": 0}),
    "customer orders", "key:l c_mktsegment:s orders_F:l orders_O:l",
    """SELECT c_custkey AS key, c_mktsegment,
       (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS orders_F,
       (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O') AS orders_O FROM customer""")  # fmt: skip

# Aggregates.
add(
    "aggregate_builders",
    lambda df: kpi.kpis(
        df,
        {
            "returned": agg.count_where(F.col("l_returnflag") == "R"),
            "returned_amount": agg.sum_if(F.col("l_returnflag") == "R", "amount"),
            "net": agg.signed_sum("l_returnflag", "amount", "A", "R"),
            "parts": F.countDistinct("l_partkey"),
            "returned_parts": agg.count_distinct_if(F.col("l_returnflag") == "R", "l_partkey"),
            "mean_amount": agg.avg_round("amount", 2),
            "return_rate": agg.rate(F.col("l_returnflag") == "R", 4),
            "return_pct": agg.rate(F.col("l_returnflag") == "R", 2, 100.0),
        },
        by=["l_suppkey"],
    ),
    "order_lines",
    "l_suppkey:l returned:l returned_amount:d net:d parts:l returned_parts:l mean_amount:d return_rate:d return_pct:d",
    f"""SELECT l_suppkey, COUNT(*) FILTER (l_returnflag = 'R') AS returned,
        SUM(CASE WHEN l_returnflag = 'R' THEN amount ELSE 0 END) AS returned_amount,
        SUM(CASE l_returnflag WHEN 'A' THEN amount WHEN 'R' THEN -amount ELSE 0 END) AS net,
        COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS returned_parts,
        {mean('amount', 2, 2)} AS mean_amount,
        {quotient("COUNT(*) FILTER (l_returnflag = 'R')", 'COUNT(*)', 4, 4)} AS return_rate,
        {quotient("COUNT(*) FILTER (l_returnflag = 'R')", 'COUNT(*)', 4, 2)} AS return_pct
        FROM order_lines GROUP BY l_suppkey""",
)
add("flag_counts",
    lambda df: kpi.flag_counts(
        df, {"returned": F.col("l_returnflag") == "R", "large": F.col("amount") > 50000}, {"total": F.sum("amount")}),
    "order_lines", "returned:l large:l total:d",
    """SELECT COUNT(*) FILTER (l_returnflag = 'R') AS returned, COUNT(*) FILTER (amount > 50000) AS large,
       SUM(amount) AS total FROM order_lines""")  # fmt: skip
add("flagged_share", lambda df: kpi.share(df, F.col("l_returnflag") == "R"), "lineitem", "share:d",
    "SELECT COUNT(*) FILTER (l_returnflag = 'R') / (COUNT(*) + 0.001e0) AS share FROM lineitem")
add("min_sample", lambda df: kpi.min_sample(df, ["l_partkey"], 30, {"total": F.sum("amount")}), "order_lines",
    "l_partkey:l cnt:l total:d",
    """SELECT l_partkey, COUNT(*) AS cnt, SUM(amount) AS total FROM order_lines GROUP BY l_partkey
       HAVING COUNT(*) < 30""")  # fmt: skip
add("distinct_values", lambda df: kpi.distinct_values(df, "event_type"), "events", "event_type:s",
    "SELECT DISTINCT event_type FROM events")
add("existence_probe", lambda df: df.filter(F.col("o_totalprice") > 400000).limit(1).agg(
        (F.count(F.lit(1)) > 0).alias("found")), "orders", "found:b",
    "SELECT COUNT(*) > 0 AS found FROM orders WHERE o_totalprice > 400000")
add("between_dates", lambda df: df.filter(F.col("ship_date").between("1997-03-01", "1997-06-30")), "order_lines",
    f"{_KEYS} ship_date:D",
    "SELECT * FROM order_lines WHERE ship_date BETWEEN DATE '1997-03-01' AND DATE '1997-06-30'")
add("recent_rows", lambda df: df.filter(F.col("ship_date") >= F.date_sub(dq.as_of_date(AS_OF), 400)), "order_lines",
    f"{_KEYS} ship_date:D", f"SELECT * FROM order_lines WHERE ship_date >= DATE '{AS_OF}' - 400")
add("top_orders",
    lambda df: kpi.top_n(df, [F.desc("o_totalprice")], 10, ["o_orderkey"]), "orders", "o_orderkey:l o_totalprice:d",
    "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")

# Windows.
add("rolling_rows",
    lambda df: windows.rolling_rows(df, ["l_suppkey"], "ship_date", F.sum("amount"), 7, "rolling"),
    "order_lines", "l_suppkey:l ship_date:D rolling:d",
    """SELECT l_suppkey, ship_date, SUM(amount) OVER (PARTITION BY l_suppkey ORDER BY ship_date
       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling
       FROM (SELECT l_suppkey, ship_date, SUM(amount) AS amount FROM order_lines GROUP BY ALL)""")  # fmt: skip
add("rolling_days",
    lambda df: windows.rolling_days(df, ["l_suppkey"], "ship_date", F.sum("amount"), 7, "rolling"),
    "order_lines", "l_suppkey:l ship_date:D rolling:d",
    """SELECT l_suppkey, ship_date, SUM(amount) OVER (PARTITION BY l_suppkey ORDER BY ship_date
       RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS rolling
       FROM (SELECT l_suppkey, ship_date, SUM(amount) AS amount FROM order_lines GROUP BY ALL)""")  # fmt: skip
# Half of the rows share one value, and some are NULL.
DOMAIN["hot_values"] = """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_linestatus = 'F' THEN 100 WHEN l_linenumber = 7 THEN NULL
                ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) END AS amount
    FROM {lineitem}"""
add("dense_rank_hot_value", lambda df: windows.dense_rank_by(df, "amount", "position"), "hot_values",
    "l_orderkey:l l_linenumber:l l_partkey:l amount:d position:l",
    "SELECT *, DENSE_RANK() OVER (ORDER BY amount DESC NULLS LAST) AS position FROM hot_values")

# Column rules and scalar functions.
add(
    "band_and_rules",
    lambda df: df.select(
        "o_orderkey",
        cond.band("o_totalprice", [(400000, "A"), (200000, "B"), (50000, "C")], "D").alias("band"),
        cond.rules(
            [
                ((F.col("o_totalprice") > 300000) & (F.col("o_orderstatus") == "F"), "large paid"),
                (F.col("o_totalprice") > 300000, "large"),
                (F.col("o_orderstatus").isin("O", "P"), "open"),
            ],
            "other",
        ).alias("rule"),
        cond.indicator_sum(
            [(F.col("o_orderstatus") == "F", 2.5), (F.col("o_orderpriority") == "1-URGENT", 1.5)]
        ).alias("points"),
        cond.ratio("o_totalprice", F.col("o_custkey")).alias("per_key"),
        cond.ratio("o_totalprice", F.col("o_custkey"), "eps").alias("per_key_eps"),
        cond.lookup("o_orderstatus", {"F": 1, "O": 2}, 0).alias("code"),
    ),
    "orders", "o_orderkey:l band:s rule:s points:d per_key:d per_key_eps:d code:l",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'A' WHEN o_totalprice >= 200000 THEN 'B'
           WHEN o_totalprice >= 50000 THEN 'C' ELSE 'D' END AS band,
       CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'F' THEN 'large paid' WHEN o_totalprice > 300000 THEN 'large'
           WHEN o_orderstatus IN ('O', 'P') THEN 'open' ELSE 'other' END AS rule,
       CASE WHEN o_orderstatus = 'F' THEN 2.5 ELSE 0 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 1.5 ELSE 0 END
           AS points,
       CASE WHEN o_custkey > 0 THEN o_totalprice / o_custkey END AS per_key,
       o_totalprice / (o_custkey + 0.01e0) AS per_key_eps, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END
           AS code FROM orders""",
)
add(
    "formulas",
    lambda df: df.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        formulas.age_years(F.col("l_shipdate").cast("date"), dq.as_of_date("2031-01-01")).alias("age"),
        formulas.bmi(F.col("l_quantity") + 40, F.lit(100) + F.col("l_linenumber") * 10).alias("bmi"),
        formulas.adjusted_dosage("l_quantity").alias("dosage"),
        formulas.deviation("l_quantity", 24.0).alias("deviation"),
        F.round(formulas.annuity_payment("l_extendedprice", F.col("l_tax") * 100), 3).alias("payment"),
    ),
    "lineitem", "l_orderkey:l l_linenumber:l l_partkey:l age:l bmi:d dosage:d deviation:d payment:d",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       FLOOR(DATE_DIFF('day', CAST(l_shipdate AS DATE), DATE '2031-01-01') / 365.25) AS age,
       (l_quantity + 40) / POW((100 + l_linenumber * 10) / 100, 2) AS bmi, l_quantity * 0.85e0 + 12.5e0 AS dosage,
       ABS(l_quantity - 24e0) / 24e0 AS deviation,
       ROUND(l_extendedprice * (l_tax * 100 / 12 / 100) * POW(1 + l_tax * 100 / 12 / 100, 360)
           / NULLIF(POW(1 + l_tax * 100 / 12 / 100, 360) - 1, 0), 3) AS payment FROM lineitem""",
)
add(
    "scalar_functions",
    lambda df: df.select(
        "c_custkey",
        F.lower("c_name").alias("lower_name"),
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("joined"),
        F.substring("c_name", -4, 4).alias("tail"),
        F.get(F.split("c_name", "#"), F.lit(1)).alias("number"),
        F.sha2("c_name", 256).alias("hash"),
        F.col("c_name").rlike("0[0-4]$").alias("low_number"),
        F.floor("c_acctbal").alias("floor_balance"),
        F.abs("c_acctbal").alias("abs_balance"),
        F.coalesce(F.nullif("c_nationkey", F.lit(3)), F.lit(-1)).alias("nation_or_default"),
        (-F.col("c_nationkey")).alias("negated"),
        (F.col("c_custkey") % 7).alias("remainder"),
        F.add_months(F.lit(AS_OF).cast("date"), F.col("c_nationkey")).alias("later"),
        F.date_sub(F.lit(AS_OF).cast("date"), F.col("c_nationkey")).alias("earlier"),
    ),
    "customer",
    "c_custkey:l lower_name:s joined:s tail:s number:s hash:s low_number:b floor_balance:l abs_balance:d "
    "nation_or_default:l negated:l remainder:l later:D earlier:D",
    f"""SELECT c_custkey, LOWER(c_name) AS lower_name, c_mktsegment || '-' || c_nationkey AS joined,
        SUBSTRING(c_name, -4, 4) AS tail, string_split(c_name, '#')[2] AS number, sha256(c_name) AS hash,
        regexp_matches(c_name, '0[0-4]$') AS low_number, FLOOR(c_acctbal) AS floor_balance, ABS(c_acctbal) AS abs_balance,
        COALESCE(NULLIF(c_nationkey, 3), -1) AS nation_or_default, -c_nationkey AS negated, c_custkey % 7 AS remainder,
        DATE '{AS_OF}' + to_months(c_nationkey) AS later, DATE '{AS_OF}' - c_nationkey AS earlier FROM customer""",
)
