"""Queries over the star schema that exercise every operator, each with its SQL.

A query and its SQL stand together; names of columns are the same in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import parse as P
from loomwork.functions import text as X
from loomwork.operators.constraints import Constraints
from loomwork.operators.link import LinkConfig, duplicate_classes, find_duplicates, link
from loomwork.operators.lookups import first_spelling, in_order, resolve, vocabulary, with_ids
from loomwork.operators.upsert import upsert
from loomwork.plans import analytics as A
from loomwork.plans import ledger as L
from loomwork.plans import report as R
from loomwork.registry import QUERIES, SQL, Tables, query

__all__ = ["QUERIES", "SQL", "entry"]

#: The linkage as DuckDB's jaro_winkler_similarity scores it.
SQL_SCORER = LinkConfig(floor_transpositions=True, boost_threshold=0.7)


def entry(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["fuzzy_full_name"](spark, folder)


# Cash book -----------------------------------------------------------------


def _cash(t: Tables) -> DataFrame:
    """Customers' balances as a cash book: every seventh has no date, every eleventh both sides, every thirteenth none."""
    key, amount = F.col("c_custkey"), F.col("c_acctbal")
    income = F.when(key % 13 == 0, 0.0).when(amount >= 0, amount).otherwise(F.when(key % 11 == 0, 1.0).otherwise(0.0))
    expense = F.when(key % 13 == 0, 0.0).when(amount < 0, -amount).otherwise(F.when(key % 11 == 0, 1.0).otherwise(0.0))
    day = F.when(key % 7 == 0, "0000-00-00").otherwise("2024-01-01")
    return t.customer.select(key.alias("id"), income.alias("income"), expense.alias("expense"), day.alias("day"))


_CASH_SQL = """SELECT c_custkey AS id,
 CASE WHEN c_custkey % 13 = 0 THEN 0.0 WHEN c_acctbal >= 0 THEN c_acctbal WHEN c_custkey % 11 = 0 THEN 1.0 ELSE 0.0 END AS income,
 CASE WHEN c_custkey % 13 = 0 THEN 0.0 WHEN c_acctbal < 0 THEN -c_acctbal WHEN c_custkey % 11 = 0 THEN 1.0 ELSE 0.0 END AS expense,
 CASE WHEN c_custkey % 7 = 0 THEN '0000-00-00' ELSE '2024-01-01' END AS day FROM customer"""


@query(
    "cash_route_counts",
    f"""WITH c AS ({_CASH_SQL}), r AS (SELECT *, CASE WHEN day = '0000-00-00' THEN 'excluded_date' WHEN abs(income) < 1e-4 AND abs(expense) < 1e-4 THEN 'omitted'
 WHEN abs(income) >= 1e-4 AND abs(expense) >= 1e-4 THEN 'excluded_both' WHEN abs(income) >= 1e-4 THEN 'income' ELSE 'expense' END AS route FROM c)
 SELECT route, count(*) AS n, CAST(sum(CAST(income AS DECIMAL(10,2)) + CAST(expense AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total FROM r GROUP BY route""",
)
def _(t: Tables) -> DataFrame:
    rows = _cash(t).withColumn("route", P.cash_route(F.col("day"), F.col("income"), F.col("expense")))
    return rows.groupBy("route").agg(F.count("*").alias("n"), F.sum(F.col("income").cast("decimal(10,2)") + F.col("expense").cast("decimal(10,2)")).cast("decimal(20,2)").alias("total"))


@query(
    "cash_decimal_comma_parse",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '  ' ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS amount_text FROM orders)
 SELECT o_orderkey, CASE WHEN trim(amount_text) = '' THEN CAST(0 AS DECIMAL(10,2)) ELSE CAST(replace(amount_text, ',', '.') AS DECIMAL(10,2)) END AS amount, nullif(trim(amount_text), '') IS NULL AS blank FROM o""",
)
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 10 == 0, "  ").otherwise(F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")))
    rows = t.orders.select("o_orderkey", text.alias("amount_text"))
    return rows.select("o_orderkey", P.money(P.decimal_comma(F.col("amount_text"))).alias("amount"), X.keep_unless_blank(F.col("amount_text")).isNull().alias("blank"))


def _entries(t: Tables) -> DataFrame:
    return t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "income").otherwise("expense").alias("type"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )


_ENTRIES_SQL = """SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderstatus = 'F' THEN 'income' ELSE 'expense' END AS type, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders"""
_TOTALS_SQL = f"""SELECT period, sum(CASE WHEN type = 'income' THEN amount ELSE 0 END) AS total_income, sum(CASE WHEN type = 'expense' THEN amount ELSE 0 END) AS total_expenses,
 sum(CASE WHEN type = 'income' THEN amount ELSE -amount END) AS net FROM ({_ENTRIES_SQL}) GROUP BY period"""


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(20,2)") for c in names})


@query("cash_period_totals", f"SELECT period, CAST(total_income AS DECIMAL(20,2)) AS total_income, CAST(total_expenses AS DECIMAL(20,2)) AS total_expenses, CAST(net AS DECIMAL(20,2)) AS net FROM ({_TOTALS_SQL})")
def _(t: Tables) -> DataFrame:
    return _money(A.period_totals(_entries(t)), "total_income", "total_expenses", "net")


@query(
    "cash_running_balance",
    f"""SELECT period, CAST(net AS DECIMAL(20,2)) AS net, CAST(sum(net) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS DECIMAL(20,2)) AS closing_balance,
 CAST(sum(net) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) - net AS DECIMAL(20,2)) AS opening_balance FROM ({_TOTALS_SQL})""",
)
def _(t: Tables) -> DataFrame:
    return _money(A.running_balance(A.period_totals(_entries(t)).select("period", "net")), "net", "closing_balance", "opening_balance")


@query(
    "cash_current_balance",
    f"""WITH e AS ({_ENTRIES_SQL}), s AS (SELECT last_day(CAST(period || '-01' AS DATE)) AS period_end, sum(net) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS closing_balance FROM ({_TOTALS_SQL})),
 l AS (SELECT * FROM s WHERE period_end < DATE '2001-01-01' ORDER BY period_end DESC LIMIT 1)
 SELECT CAST(l.period_end AS VARCHAR) AS period_end, CAST(l.closing_balance + coalesce(sum(CASE WHEN e.type = 'income' THEN e.amount END), 0) - coalesce(sum(CASE WHEN e.type = 'expense' THEN e.amount END), 0) AS DECIMAL(20,2)) AS balance
 FROM l LEFT JOIN e ON e.date > l.period_end GROUP BY l.period_end, l.closing_balance""",
)
def _(t: Tables) -> DataFrame:
    balances = A.running_balance(A.period_totals(_entries(t)))
    end = F.last_day(F.to_date(F.concat("period", F.lit("-01"))))
    snapshots = balances.select(end.alias("period_end"), "closing_balance", F.when(end < F.lit("2001-01-01").cast("date"), "closed").otherwise("open").alias("status"))
    return _money(A.current_balance(snapshots, _entries(t)), "balance").withColumn("period_end", F.col("period_end").cast("string"))


# Text ----------------------------------------------------------------------


@query(
    "text_normalize_keys",
    """WITH n AS (SELECT 'part' AS kind, p_partkey AS k, p_name || ' - (' || p_brand || ')' AS said FROM part UNION ALL SELECT 'customer', c_custkey, c_name || ' ' || c_mktsegment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier)
 SELECT kind, k, translate(regexp_replace(upper(strip_accents('Nguyễn Jòsé Łuś ' || CASE WHEN k % 2 = 0 THEN 'Čapek' ELSE 'ÿèö' END) || ' ñandú ' || trim(said)), '\\s+', ' ', 'g'), '.,;:!?''"-()[]{}Ú', 'U') AS norm FROM n""".replace("""'.,;:!?''"-()[]{}Ú', 'U'""", """'Ú.,;:!?''"-()[]{}', 'U'""").replace("\\\\", "\\"),
)
def _(t: Tables) -> DataFrame:
    """Names of three tables after words with accents, of which some are letters and some marks that follow a letter."""
    names = (
        t.part.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("k"), F.concat("p_name", F.lit(" - ("), "p_brand", F.lit(")")).alias("said"))
        .unionByName(t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("said")))
        .unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("said")))
    )
    words = F.concat(F.lit(" \t Nguye\u0302\u0303n Jo\u0300s\u00e9  \u0141us\u0301 "), F.when(F.col("k") % 2 == 0, "\u010capek").otherwise("y\u0308e\u0300\u00f6"), F.lit(" n\u0303and\u00fa "))
    return names.select("kind", "k", X.normalize_text(F.concat(words, "said", F.lit("! "))).alias("norm"))


@query("text_fold_accents", """SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS letters, CAST(sum(CAST('0x' || substr(md5(translate(text, 'áàâäãåéèêëíìîïóòôöõúùûüçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇ', 'aaaaaaeeeeiiiiooooouuuucAAAAAAEEEEIIIIOOOOOUUUUC')), 1, 15) AS BIGINT)) AS VARCHAR) AS folded FROM documents GROUP BY lang""")
def _(t: Tables) -> DataFrame:
    """A sum of hashes: it takes any order, and is combined before the shuffle."""
    h = F.conv(F.substring(F.md5(X.fold_accents(F.col("text"))), 1, 15), 16, 10).cast("decimal(20,0)")
    return t.documents.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("letters"), F.sum(h).cast("string").alias("folded"))


@query("text_br_to_newline", r"""SELECT page_id, length(regexp_replace(html, '<\s*br\s*/?\s*>', chr(10), 'gi')) AS letters, length(html) - length(replace(html, '<br>', '')) AS marked FROM pages""")
def _(t: Tables) -> DataFrame:
    clean = X.br_to_newline(F.col("html"))
    return t.pages.select("page_id", F.length(clean).cast("long").alias("letters"), (F.length("html") - F.length(F.replace("html", F.lit("<br>"), F.lit("")))).cast("long").alias("marked"))


@query("text_trim_nullify", r"""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN chr(9) || '  ' WHEN turn % 3 = 1 THEN chr(9) || text || chr(10) ELSE text END AS said FROM conversations)
 SELECT conv_id, turn, nullif(regexp_replace(said, '^\s+|\s+$', '', 'g'), '') IS NULL AS blank, CAST(coalesce(length(regexp_replace(said, '^\s+|\s+$', '', 'g')), 0) AS BIGINT) AS letters FROM c""")
def _(t: Tables) -> DataFrame:
    said = F.when(F.col("turn") % 3 == 0, "\t  ").when(F.col("turn") % 3 == 1, F.concat(F.lit("\t"), "text", F.lit("\n"))).otherwise(F.col("text"))
    rows = t.conversations.select("conv_id", "turn", said.alias("said"))
    return rows.select("conv_id", "turn", X.blank_to_null(F.col("said")).isNull().alias("blank"), F.length(X.blank_to_empty(F.col("said"))).cast("long").alias("letters"))


# Codes and dates -------------------------------------------------------------


@query(
    "code_map_status",
    """WITH o AS (SELECT CASE o_orderstatus WHEN 'P' THEN '0' WHEN 'F' THEN '2' WHEN 'O' THEN CASE WHEN o_orderkey % 5 = 0 THEN '9' END END AS code, CASE WHEN o_orderkey % 2 = 0 THEN ' m' ELSE 'x' END AS sex FROM orders
 UNION ALL SELECT CASE l_returnflag WHEN 'A' THEN ' 1 ' WHEN 'N' THEN '3' ELSE 'R' END, CASE l_linestatus WHEN 'F' THEN 'f ' ELSE '' END FROM lineitem)
 SELECT CASE trim(code) WHEN '0' THEN 'pending' WHEN '1' THEN 'confirmed' WHEN '2' THEN 'completed' WHEN '3' THEN 'cancelled' ELSE 'pending' END AS status, code IS NOT NULL AND trim(code) NOT IN ('0','1','2','3') AS odd,
 CASE upper(trim(sex)) WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' END AS gender, count(*) AS n FROM o GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    status, flag = F.col("o_orderstatus"), F.col("l_returnflag")
    code = F.when(status == "P", "0").when(status == "F", "2").when((status == "O") & (F.col("o_orderkey") % 5 == 0), "9")
    rows = t.orders.select(code.alias("code"), F.when(F.col("o_orderkey") % 2 == 0, " m").otherwise("x").alias("sex"))
    rows = rows.unionByName(t.lineitem.select(F.when(flag == "A", " 1 ").when(flag == "N", "3").otherwise("R").alias("code"), F.when(F.col("l_linestatus") == "F", "f ").otherwise("").alias("sex")))
    return rows.groupBy(P.appointment_status(F.col("code")).alias("status"), P.unknown_status(F.col("code")).alias("odd"), P.gender(F.col("sex")).alias("gender")).agg(F.count("*").alias("n"))


@query(
    "enum_validate",
    """WITH v AS (SELECT c_mktsegment AS said, CASE WHEN lower(trim(c_mktsegment)) IN ('building', 'household', 'machinery') THEN lower(c_mktsegment) END AS allowed FROM customer
 UNION ALL SELECT o_orderstatus, CASE WHEN o_orderstatus IN ('F', 'O') THEN lower(o_orderstatus) END FROM orders) SELECT said, allowed, count(*) AS n, count(*) FILTER (WHERE allowed IS NULL) AS violations FROM v GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    def checked(df: DataFrame, column: str, *allowed: str) -> DataFrame:
        word = F.lower(X.trim_u(F.col(column)))
        return df.select(F.col(column).alias("said"), F.when(word.isin(*allowed), word).alias("allowed"))

    rows = checked(t.customer, "c_mktsegment", "building", "household", "machinery").unionByName(checked(t.orders, "o_orderstatus", "f", "o"))
    return rows.groupBy("said", "allowed").agg(F.count("*").alias("n"), F.sum(F.col("allowed").isNull().cast("long")).alias("violations"))


@query(
    "date_sentinel_strict",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '0000-00-00' WHEN o_orderkey % 10 = 1 THEN ' ' WHEN o_orderkey % 10 = 2 THEN '2023-13-45' WHEN o_orderkey % 10 = 3 THEN '1/2/2023' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
 SELECT o_orderkey, CASE WHEN regexp_full_match(day, '\\d{4}-\\d{2}-\\d{2}') THEN CAST(TRY_CAST(day AS DATE) AS VARCHAR) END AS strict, trim(day) NOT IN ('', '0000-00-00') AND (NOT regexp_full_match(day, '\\d{4}-\\d{2}-\\d{2}') OR TRY_CAST(day AS DATE) IS NULL) AS invalid FROM o""".replace("\\\\", "\\"),
)
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 10
    day = F.when(k == 0, "0000-00-00").when(k == 1, " ").when(k == 2, "2023-13-45").when(k == 3, "1/2/2023").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", P.strict_date(day).cast("string").alias("strict"), P.invalid_date(day).alias("invalid"))


@query(
    "coalesce_contact",
    """SELECT s_suppkey, coalesce(nullif(nullif(trim(CASE WHEN s_suppkey % 3 = 0 THEN '0' WHEN s_suppkey % 3 = 1 THEN ' ' ELSE s_name END), ''), '0'), nullif(nullif(trim(CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE '' END), ''), '0')) AS contact FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    first = F.when(k % 3 == 0, "0").when(k % 3 == 1, " ").otherwise(F.col("s_name"))
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", P.phone(first, F.when(k % 2 == 0, F.col("n_name")).otherwise("")).alias("contact"))


# Lookups ---------------------------------------------------------------------


@query(
    "lookup_distinct_vocab",
    """WITH v AS (SELECT DISTINCT value FROM (SELECT p_type AS value FROM part UNION ALL SELECT p_brand FROM part UNION ALL SELECT p_name FROM part))
 SELECT translate(upper(value), '.,;:!?''"-()[]{}', '') AS norm, min(value) AS value, count(DISTINCT value) AS spellings FROM v GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return first_spelling(vocabulary(t.part, "p_type", "p_brand", "p_name"), "value")


@query(
    "lookup_resolve_join",
    """WITH l AS (SELECT upper(p_name) AS norm, min(p_partkey) AS id FROM part WHERE p_name < 'r' GROUP BY 1)
 SELECT p_brand, count(*) AS n, count(l.id) AS resolved, CAST(sum(l.id) AS BIGINT) AS id_sum FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN l ON l.norm = upper(p_name) GROUP BY p_brand""",
)
def _(t: Tables) -> DataFrame:
    lookup = t.part.where("p_name < 'r'").groupBy(X.normalize_text(F.col("p_name")).alias("norm")).agg(F.min("p_partkey").alias("id"))
    # Names are resolved once for each part, before the many rows that use them.
    parts = resolve(t.part.select("p_partkey", "p_brand", F.concat(F.lit(" "), "p_name").alias("name")), "name", lookup, into="found")
    rows = t.lineitem.select("l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_brand").agg(F.count("*").alias("n"), F.count("found").alias("resolved"), F.sum("found").alias("id_sum"))


@query("lookup_dedup_first_wins", "SELECT upper(p_name) AS norm, min(p_partkey) AS first_key, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY 1")
def _(t: Tables) -> DataFrame:
    first = t.part.groupBy(X.normalize_text(F.col("p_name")).alias("norm")).agg(F.min(F.struct("p_partkey", "p_name")).alias("first"))
    return first.select("norm", F.col("first.p_partkey").alias("first_key"), F.col("first.p_name").alias("p_name"))


@query("id_assignment_after_max", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, (SELECT coalesce(max(o_orderkey), 0) FROM orders) + row_number() OVER (ORDER BY o_orderpriority, o_orderkey DESC) AS id FROM orders")
def _(t: Tables) -> DataFrame:
    """Rows with what they carry: ids from one written table, so counts and rows agree."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", (-F.col("o_orderkey")).alias("back"))
    top = t.orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("top"))
    numbered = with_ids(rows, "o_orderpriority", "back", name="place")
    return numbered.join(F.broadcast(top)).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", (F.col("top") + F.col("place")).alias("id"))


@query(
    "upsert_updated_at",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 WHEN c_custkey % 3 = 1 AND c_custkey % 2 = 0 THEN NULL ELSE c_acctbal END AS balance, c_name AS name, '2024-01-01' AS created, CASE WHEN c_custkey % 3 = 0 OR (c_custkey % 3 = 1 AND c_custkey % 2 = 0) THEN '2024-02-01' ELSE '2024-01-01' END AS updated FROM customer
 UNION ALL SELECT c_custkey + 1000000000, c_acctbal, NULL, '2024-02-01', '2024-02-01' FROM customer WHERE c_custkey % 10 = 0""",
)
def _(t: Tables) -> DataFrame:
    """A third of the rows changes, a third comes again as it is or with a null, new keys come in."""
    k, day = F.col("c_custkey"), lambda d: F.lit(d).cast("timestamp")
    have = t.customer.select(k.alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"), day("2024-01-01").alias("created_at"), day("2024-01-01").alias("updated_at"))
    balance = F.when(k % 3 == 0, F.col("c_acctbal") + 1).when(k % 2 == 1, F.col("c_acctbal"))
    new = t.customer.where(k % 3 != 2).select(k.alias("id"), balance.alias("balance")).unionByName(t.customer.where(k % 10 == 0).select((k + 1000000000).alias("id"), F.col("c_acctbal").alias("balance")))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd")
    return upsert(have, new, "id", at=day("2024-02-01")).select("id", "balance", "name", shown("created_at").alias("created"), shown("updated_at").alias("updated"))


# Joins -----------------------------------------------------------------------


@query(
    "dim_resolve_left",
    """SELECT c_custkey, n.n_name, n.n_nationkey IS NULL AND code IS NOT NULL AS missed FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN c_nationkey + 20 ELSE c_nationkey END AS code FROM customer) LEFT JOIN nation n ON n.n_nationkey = code""",
)
def _(t: Tables) -> DataFrame:
    k, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    said = F.when(k % 4 == 0, "0").when(k % 4 == 1, F.concat(F.lit(" +"), (F.col("c_nationkey") + 20).cast("string"), F.lit(" x"))).otherwise(F.concat(F.lit("+"), F.when(F.col("c_nationkey") == 0, F.lit("00")).otherwise(nation)))
    code = F.when(k % 4 == 0, P.doctor_code(said)).otherwise(P.integer_prefix(said))
    rows = t.customer.select("c_custkey", code.alias("code"))
    return rows.join(t.nation, F.col("code") == F.col("n_nationkey"), "left").select("c_custkey", "n_name", (F.col("n_nationkey").isNull() & F.col("code").isNotNull()).alias("missed"))


@query(
    "fk_existence_nullout",
    """SELECT l_returnflag, count(*) AS n, count(o.o_orderkey) AS kept, count(*) FILTER (WHERE o.o_orderkey IS NULL) AS nulled FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o.o_orderkey GROUP BY l_returnflag""",
)
def _(t: Tables) -> DataFrame:
    known = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey").distinct()
    rows = t.lineitem.select("l_orderkey", "l_returnflag").join(known, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("o_orderkey").alias("kept"), F.sum(F.col("o_orderkey").isNull().cast("long")).alias("nulled"))


@query(
    "fk_inner_excluded",
    """SELECT o_orderstatus, c_custkey IS NULL AS excluded, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(20,2)) AS fees FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", F.col("c_acctbal").cast("decimal(12,2)").alias("fee"))
    rows = t.orders.select("o_custkey", "o_orderstatus").join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy("o_orderstatus", F.col("c_custkey").isNull().alias("excluded")).agg(F.count("*").alias("n"), F.sum("fee").cast("decimal(20,2)").alias("fees"))


@query(
    "unpivot_techniques",
    """WITH u AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_returnflag AS a, CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE l_linestatus END AS b, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag END AS c FROM lineitem),
 r AS (SELECT k, trim(a) AS value, 1 AS order_index FROM u UNION ALL SELECT k, trim(b), 2 FROM u UNION ALL SELECT k, trim(c), 3 FROM u), d AS (SELECT k, value, min(order_index) AS order_index FROM r WHERE value <> '' GROUP BY k, value)
 SELECT value, order_index, count(*) AS n FROM d GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"),
        F.col("l_returnflag").alias("a"),
        F.when(F.col("l_linenumber") % 2 == 0, " ").otherwise(F.col("l_linestatus")).alias("b"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_returnflag")).alias("c"),
    )
    return in_order(rows, "k", "a", "b", "c").groupBy("value", "order_index").agg(F.count("*").alias("n"))


@query(
    "constraint_violations",
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_totalprice - 1000 AS amount, o_orderkey % 5000 AS slot, o_custkey FROM orders),
 k AS (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 0), v AS (
 SELECT 'not_null:priority' AS violation FROM m WHERE priority IS NULL UNION ALL SELECT 'check:amount' FROM m WHERE NOT amount > 0
 UNION ALL SELECT 'unique:slot' FROM (SELECT row_number() OVER (PARTITION BY slot ORDER BY o_orderkey) AS place FROM m) WHERE place > 1
 UNION ALL SELECT 'foreign_key:o_custkey' FROM m WHERE o_custkey NOT IN (SELECT c_custkey FROM k)) SELECT violation, count(*) AS n FROM v GROUP BY violation""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")).alias("priority"), (F.col("o_totalprice") - 1000).alias("amount"), (F.col("o_orderkey") % 5000).alias("slot"), "o_custkey")
    rules = Constraints(not_null=["priority"], checks={"amount": F.col("amount") > 0}, unique={"slot": ["slot"]}, references={"o_custkey": (t.customer.where("c_custkey % 9 <> 0"), "c_custkey")}, order=["o_orderkey"])
    return rules.violations(rows).select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))


# Linkage ---------------------------------------------------------------------


def _typed(t: Tables, full: bool) -> tuple[DataFrame, DataFrame]:
    """Names with a letter dropped, by part; and the distinct names as a pool, numbered in order."""
    words = F.split("p_name", " ")
    inputs = t.part.select(
        F.col("p_partkey").alias("input_id"),
        F.when(F.col("p_partkey") % 3 == 0, words[0]).when(F.col("p_partkey") % 3 == 1, F.concat(F.substring(words[0], 1, 2), F.expr("substring(split(p_name, ' ')[0], 4)"))).otherwise(F.concat(words[0], F.lit("x"))).alias("last_name"),
        F.when(F.col("p_partkey") % 5 == 0, "").otherwise(words[1]).alias("first_name"),
    )
    if full:
        pool = t.part.select(words[0].alias("last_name"), words[1].alias("first_name")).distinct()
        return inputs, with_ids(pool, "last_name", "first_name")
    return inputs.drop("first_name"), with_ids(t.part.select(words[0].alias("last_name"), F.lit("").alias("first_name")).distinct(), "last_name")


_INPUTS_SQL = """i AS (SELECT p_partkey AS input_id, CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1) WHEN p_partkey % 3 = 1 THEN substr(split_part(p_name, ' ', 1), 1, 2) || substr(split_part(p_name, ' ', 1), 4) ELSE split_part(p_name, ' ', 1) || 'x' END AS last_name,
 CASE WHEN p_partkey % 5 = 0 THEN '' ELSE split_part(p_name, ' ', 2) END AS first_name FROM part), d AS (SELECT DISTINCT last_name, first_name FROM i)"""
_RANK_SQL = """r AS (SELECT *, row_number() OVER w AS place, lead(score) OVER w AS next_score FROM s WHERE score >= 0.75 WINDOW w AS (PARTITION BY last_name, first_name ORDER BY score DESC, id)),
 a AS (SELECT i.input_id, i.last_name, i.first_name, CASE WHEN r.id IS NULL THEN 'no_match' WHEN r.score >= 0.92 AND (r.next_score IS NULL OR r.score - r.next_score >= 0.05) THEN 'auto_linked' ELSE 'manual_review' END AS outcome, r.id, r.score FROM i LEFT JOIN r ON r.last_name = i.last_name AND r.first_name = i.first_name AND r.place = 1)"""
_FULL_SQL = f"""WITH {_INPUTS_SQL}, p AS (SELECT row_number() OVER (ORDER BY l, f) AS id, l, f FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS l, split_part(p_name, ' ', 2) AS f FROM part)),
 s AS (SELECT last_name, first_name, id, 0.6::DOUBLE * jaro_winkler_similarity(upper(last_name), upper(l)) + 0.4::DOUBLE * CASE WHEN first_name = '' THEN 0 ELSE jaro_winkler_similarity(upper(first_name), upper(f)) END AS score FROM d, p), {_RANK_SQL}"""
_LAST_SQL = f"""WITH {_INPUTS_SQL.replace("CASE WHEN p_partkey % 5 = 0 THEN '' ELSE split_part(p_name, ' ', 2) END AS first_name", "'' AS first_name")}, p AS (SELECT row_number() OVER (ORDER BY l) AS id, l FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS l FROM part)),
 s AS (SELECT last_name, first_name, id, jaro_winkler_similarity(upper(last_name), upper(l)) AS score FROM d, p), {_RANK_SQL}"""
_OUTCOME_SQL = " SELECT input_id, outcome, coalesce(CASE WHEN outcome = 'auto_linked' THEN id END, 0) AS candidate_id, coalesce(round(score, 6), 0) AS score FROM a"


def _outcomes(found: DataFrame) -> DataFrame:
    return found.select("input_id", "outcome", F.coalesce("candidate_id", F.lit(0)).alias("candidate_id"), F.coalesce(F.round("score", 6), F.lit(0.0)).alias("score"))


@query("fuzzy_last_name_only", _LAST_SQL + _OUTCOME_SQL)
def _(t: Tables) -> DataFrame:
    return _outcomes(link(*_typed(t, False), SQL_SCORER, mode="last_name_only"))


@query("fuzzy_full_name", _FULL_SQL + _OUTCOME_SQL)
def _(t: Tables) -> DataFrame:
    return _outcomes(link(*_typed(t, True), SQL_SCORER))


@query("fuzzy_candidate_list", _FULL_SQL + " SELECT a.input_id, count(*) AS candidates, round(min(r.score), 6) AS least, CAST(sum(r.id * r.place) AS BIGINT) AS order_sum FROM a JOIN r ON r.last_name = a.last_name AND r.first_name = a.first_name WHERE a.outcome = 'manual_review' GROUP BY a.input_id")
def _(t: Tables) -> DataFrame:
    rows = link(*_typed(t, True), SQL_SCORER).where("outcome = 'manual_review'").select("input_id", F.posexplode("considered").alias("pos", "c"))
    return rows.groupBy("input_id").agg(F.count("*").alias("candidates"), F.round(F.min("c.score"), 6).alias("least"), F.sum(F.col("c.id") * (F.col("pos") + 1)).alias("order_sum"))


@query(
    "fuzzy_duplicates",
    """WITH p AS (SELECT row_number() OVER (ORDER BY l, f) AS id, l, f FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS l, split_part(p_name, ' ', 2) || 's' AS f FROM part UNION SELECT DISTINCT split_part(p_name, ' ', 1), split_part(p_name, ' ', 2) FROM part)),
 s AS (SELECT a.id AS id_1, b.id AS id_2, 0.6::DOUBLE * jaro_winkler_similarity(upper(a.l), upper(b.l)) + 0.4::DOUBLE * jaro_winkler_similarity(upper(a.f), upper(b.f)) AS score FROM p a JOIN p b ON a.id < b.id) SELECT id_1, id_2, round(score, 6) AS score FROM s WHERE score >= 0.92""",
)
def _(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    names = t.part.select("p_name").distinct().select(words[0].alias("last_name"), F.explode(F.array(words[1], F.concat(words[1], F.lit("s")))).alias("first_name")).distinct()
    return find_duplicates(with_ids(names, "last_name", "first_name"), SQL_SCORER).withColumn("score", F.round("score", 6))


@query(
    "fuzzy_duplicate_classes",
    """WITH c AS (SELECT min(p_partkey) AS class_id, upper(split_part(p_name, ' ', 1)) AS l, upper(split_part(p_name, ' ', 2)) AS f, count(*) AS members FROM part GROUP BY 2, 3),
 s AS (SELECT a.class_id FROM c a JOIN c b ON a.class_id <> b.class_id WHERE 0.6::DOUBLE * jaro_winkler_similarity(a.l, b.l) + 0.4::DOUBLE * jaro_winkler_similarity(a.f, b.f) >= 0.92)
 SELECT c.class_id, l AS last_name, f AS first_name, members, (SELECT count(*) FROM s WHERE s.class_id = c.class_id) AS links FROM c""",
)
def _(t: Tables) -> DataFrame:
    """All parts by the first two words of their names: a class for each normal form, and how many others it is like."""
    words = F.split("p_name", " ")
    found = duplicate_classes(t.part.select(F.col("p_partkey").alias("id"), words[0].alias("last_name"), words[1].alias("first_name")), SQL_SCORER)
    linked = found.links.select(F.explode(F.array("class_1", "class_2")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    return found.classes.join(linked, "class_id", "left").select("class_id", "last_name", "first_name", "members", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


@query("fuzzy_outcome_summary", _FULL_SQL + " SELECT outcome, count(*) AS n FROM a GROUP BY outcome")
def _(t: Tables) -> DataFrame:
    return link(*_typed(t, True), SQL_SCORER).groupBy("outcome").agg(F.count("*").alias("n"))


@query("fuzzy_parity_variant")
def _(t: Tables) -> DataFrame:
    return _outcomes(link(*_typed(t, True), LinkConfig()))


# Ledger ----------------------------------------------------------------------


def _keyed(t: Tables) -> DataFrame:
    said = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select(F.col("o_orderkey").cast("string").alias("source_pk"), F.sha2(said, 256).alias("payload_hash"), "o_orderkey", "o_orderstatus")


def _ledger(t: Tables) -> DataFrame:
    """Entries of every third order; every seventh of them has another content, every fifth was excluded."""
    k = F.col("o_orderkey")
    return _keyed(t).where(k % 3 == 0).select(
        F.lit("orders").alias("source_table"), "source_pk", F.lit("t").alias("target_table"), F.when(k % 5 != 0, k + 1000).alias("target_id"), F.when(k % 5 == 0, "excluded").otherwise("migrated").alias("status"),
        F.when(k % 7 == 0, "old").otherwise(F.col("payload_hash")).alias("payload_hash"), F.lit("2024-01-01").cast("timestamp").alias("migrated_at"),
    )


@query("ledger_new_vs_reused", "SELECT o_orderstatus, count(*) FILTER (WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0)) AS fresh, count(*) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0) AS reused FROM orders GROUP BY o_orderstatus")
def _(t: Tables) -> DataFrame:
    fresh, known = L.split(_keyed(t), _ledger(t), "orders", "source_pk")
    both = fresh.select("o_orderstatus", F.lit(1).alias("f"), F.lit(0).alias("r")).unionByName(known.select("o_orderstatus", F.lit(0).alias("f"), F.lit(1).alias("r")))
    return both.groupBy("o_orderstatus").agg(F.sum("f").alias("fresh"), F.sum("r").alias("reused"))


@query("ledger_payload_drift", "WITH k AS (SELECT o_orderkey, sha256(o_orderkey || '|' || o_orderstatus || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS h FROM orders) SELECT CAST(o_orderkey AS VARCHAR) AS source_pk, h AS payload_hash FROM k WHERE o_orderkey % 21 = 0 AND o_orderkey % 5 <> 0")
def _(t: Tables) -> DataFrame:
    _, known = L.split(_keyed(t), _ledger(t), "orders", "source_pk")
    return known.where("drifted").select("source_pk", "payload_hash")


@query("ledger_upsert_latest", "SELECT CAST(user_id AS VARCHAR) AS source_pk, max(event_id) AS target_id, arg_max(event_type, event_id) AS status FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    entries = t.events.select(F.lit("events").alias("source_table"), F.col("user_id").cast("string").alias("source_pk"), F.lit("t").alias("target_table"), F.col("event_id").alias("target_id"), F.col("event_type").alias("status"), F.lit("").alias("payload_hash"), F.timestamp_seconds(F.col("event_id")).alias("migrated_at"))
    return L.latest(entries).select("source_pk", "target_id", "status")


# Reports and analytics ---------------------------------------------------------


@query(
    "report_table_summary",
    """WITH a AS (SELECT 'orders' AS "table", CASE o_orderstatus WHEN 'F' THEN 'migrated' WHEN 'O' THEN 'reused' ELSE 'excluded' END AS type FROM orders UNION ALL SELECT 'lineitem', CASE l_returnflag WHEN 'A' THEN 'migrated' WHEN 'N' THEN 'warning' ELSE 'omitted' END FROM lineitem
 UNION ALL SELECT 'customer', CASE WHEN c_acctbal < 0 THEN 'error' ELSE 'migrated' END FROM customer)
 SELECT coalesce("table", 'total') AS "table", count(*) FILTER (WHERE type = 'migrated') AS migrated, count(*) FILTER (WHERE type = 'reused') AS reused, count(*) FILTER (WHERE type = 'excluded') AS excluded, count(*) FILTER (WHERE type = 'omitted') AS omitted, count(*) FILTER (WHERE type = 'error') AS error, count(*) FILTER (WHERE type = 'warning') AS warning FROM a GROUP BY ROLLUP ("table")""",
)
def _(t: Tables) -> DataFrame:
    said = lambda c, names, rest: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.col(c)), F.lit(rest))
    audit = (
        t.orders.select(F.lit("orders").alias("table"), said("o_orderstatus", {"F": "migrated", "O": "reused"}, "excluded").alias("type"))
        .unionByName(t.lineitem.select(F.lit("lineitem").alias("table"), said("l_returnflag", {"A": "migrated", "N": "warning"}, "omitted").alias("type")))
        .unionByName(t.customer.select(F.lit("customer").alias("table"), F.when(F.col("c_acctbal") < 0, "error").otherwise("migrated").alias("type")))
    )
    return R.summary(audit)


@query("report_top_examples", "SELECT event_type, event_id, place FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events) WHERE place <= 10")
def _(t: Tables) -> DataFrame:
    return R.examples(t.events.select("event_type", "event_id"), "event_type", order="event_id").select("event_type", "event_id", "place")


@query("agenda_by_day", "SELECT o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM orders GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return A.agenda(t.orders.select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "o_orderpriority")


@query("agenda_by_status", "SELECT o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return A.agenda(t.orders.select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderstatus").alias("status")), "o_orderpriority", status=("O", "P"))


@query("history_by_entity", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events")
def _(t: Tables) -> DataFrame:
    return A.history(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id").select("user_id", "event_id", "place")


@query("history_latest", "SELECT user_id, event_id, place FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events) WHERE place <= 3")
def _(t: Tables) -> DataFrame:
    """The three newest of every user: a top-k report."""
    return A.history(t.events.select("user_id", "event_id", "ts"), "user_id", "ts", "event_id", 3).select("user_id", "event_id", "place")


@query("search_by_name", "SELECT p_partkey, p_name FROM part WHERE ' ' || upper(p_name) || ' ' || upper(p_type) LIKE '% RED%' AND ' ' || upper(p_name) || ' ' || upper(p_type) LIKE '% ECON%'")
def _(t: Tables) -> DataFrame:
    return A.search_names(t.part, "réd  Econ", "p_name", "p_type").select("p_partkey", "p_name")


@query("search_by_document", "SELECT o_orderkey FROM orders WHERE o_orderkey % 1000 = 123")
def _(t: Tables) -> DataFrame:
    """Numbers with points in some rows and with blanks in others."""
    number = F.concat(F.lit("12"), F.when(F.col("o_orderkey") % 2 == 0, ".").otherwise(" "), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"))
    return A.search_document(t.orders.select("o_orderkey", number.alias("doc_number")), "12.123").select("o_orderkey")


@query("free_slots", "SELECT c_custkey AS slot FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def _(t: Tables) -> DataFrame:
    return A.free_slots(t.customer.select(F.col("c_custkey").alias("slot")), t.orders.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("slot")), "slot")
