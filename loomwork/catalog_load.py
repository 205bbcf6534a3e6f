"""Queries of the load: legacy tables made of the star schema, said as a dump, read, and turned into target rows.

Every table goes through a dump, so its text holds what a dump must escape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.catalog import SQL_SCORER, _LAST_SQL
from loomwork.functions import parse as P
from loomwork.functions import text as X
from loomwork.operators.lookups import with_ids
from loomwork.plans import transforms as T
from loomwork.plans.config import PipelineConfig
from loomwork.plans.pipeline import SCHEMAS, Pipeline
from loomwork.plans.store import TableStore
from loomwork.registry import Tables, query
from loomwork.scratch import shared_path
from loomwork.sources.mysqldump import Dump, counted_classes, read_mysql_dump, rendered, write_extended
from loomwork.streaming.incremental import load_stream


def dump_of(spark, tables: dict[str, DataFrame], *, crlf: bool = False, escape_breaks: bool = True) -> str:
    """The path of a dump of the tables."""
    path = shared_path(spark, "dump")
    for name, df in tables.items():
        rendered(df, name, escape_breaks=escape_breaks).write.mode("append").option("lineSep", ";\r\n" if crlf else ";\n").text(path)
    return path


def _read(t: Tables, tables: dict[str, DataFrame], **how) -> Dump:
    return read_mysql_dump(t.spark, dump_of(t.spark, tables, **how))


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


# The dump itself -------------------------------------------------------------

_HARD = "chr(39) || ' \\ ; ' || chr(10) || ';' || chr(13) || chr(10) || ';' || chr(10) || '(' || chr(9) || ',' || chr(34) || '\\n ' || chr(39) || chr(39) || '--x'"
_HARD_TEXT = "' \\ ; \n;\r\n;\n(\t,\"\\n ''--x"


def _hard(t: Tables) -> DataFrame:
    text = F.concat("c_name", F.lit(_HARD_TEXT), "c_mktsegment")
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, text).alias("said"), F.when(F.col("c_custkey") % 7 == 0, "").otherwise("NULL").alias("word"), "c_acctbal")


_HARD_SQL = f"SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name || {_HARD} || c_mktsegment END AS said, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'NULL' END AS word, c_acctbal FROM customer"


def _typed_back(df: DataFrame) -> DataFrame:
    return df.select(F.col("c_custkey").cast("long").alias("c_custkey"), "said", "word", F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("dump_roundtrip", _HARD_SQL)
def _(t: Tables) -> DataFrame:
    """Quotes, backslashes, semicolons at a line's end, both line breaks, nulls, empty texts and the word NULL."""
    return _typed_back(_read(t, {"customer": _hard(t)}).tables["customer"])


@query("dump_raw_breaks_crlf", _HARD_SQL)
def _(t: Tables) -> DataFrame:
    """The same in a dump with CRLF ends that leaves line breaks in literals as they are."""
    return _typed_back(_read(t, {"customer": _hard(t)}, crlf=True, escape_breaks=False).tables["customer"])


@query("dump_extended_insert", _HARD_SQL)
def _(t: Tables) -> DataFrame:
    """The same where one INSERT a file has all rows, in one line, and files are read in blocks of 64 KB."""
    path = shared_path(t.spark, "dump")
    write_extended(_hard(t), "customer", path, escape_breaks=False)
    return _typed_back(read_mysql_dump(t.spark, path, block_bytes=1 << 16).tables["customer"])


@query("dump_table_classes", "SELECT * FROM (VALUES ('caja', 'in_scope', 1), ('medias', 'excluded', 0), ('nation', 'unknown', 25)) v(name, class, n)")
def _(t: Tables) -> DataFrame:
    found = _read(t, {"nation": t.nation, "caja": t.region.select(_text("r_name").alias("conceptoCaja")).where("conceptoCaja = 'x'").unionByName(t.region.limit(1).select(F.lit("y").alias("conceptoCaja"))), "medias": t.region.select("r_regionkey")})
    return counted_classes(found)


# Entities --------------------------------------------------------------------


def _fichas(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    blank = F.lit("")
    values = {
        "idFicha": k.cast("string"), "tipoDoc": F.when(k % 3 == 0, " DNI ").otherwise(" "), "documento": (k + 1000000).cast("string"),
        "apellido": F.when(k % 17 == 0, " \t").otherwise(F.concat(F.lit(" O'"), "c_name")), "nombre": F.when(k % 34 == 0, "").otherwise(F.col("c_mktsegment")),
        "domicilio": F.concat("c_name", F.lit(";\n\\ 1")), "departamento": blank, "provincia": blank,
        "fechaNac": F.when(k % 4 == 0, "0000-00-00").when(k % 4 == 1, " ").when(k % 4 == 2, "1990-02-30").otherwise("1990-02-28"), "sexo": F.when(k % 3 == 0, "m").when(k % 3 == 1, "F").otherwise("?"),
        "obraSocial": blank, "nroObraSocial": blank, "telefono": F.when(k % 2 == 0, "0").otherwise(F.concat(F.lit(" 5"), k.cast("string"))), "eMail": blank, "codPostal": blank,
        "estadoCivil": F.when(k % 5 == 0, "Married").when(k % 5 == 1, " widowed ").when(k % 5 == 2, "S").otherwise(""), "profesional": F.when(k % 4 == 0, "0").otherwise(F.concat("c_nationkey", F.lit("x"))),
        "primerConsulta": F.lit("2020-01-31"), "ultimaConsulta": F.lit("0000-00-00"), "diagnostico": blank, "valorConsulta": F.when(k % 6 == 0, "").when(k % 6 == 1, "abc").otherwise(F.concat((k % 900).cast("string"), F.lit(".5 pesos"))),
    }
    return t.customer.select(*[v.alias(c) for c, v in values.items()])


@query(
    "load_patients",
    r"""SELECT CAST(c_custkey AS VARCHAR) AS source_pk, CASE WHEN c_custkey % 3 = 0 THEN 'DNI' END AS doc_type, CASE WHEN c_custkey % 17 = 0 THEN '' ELSE 'O''' || c_name END AS last_name, CASE WHEN c_custkey % 34 = 0 THEN '' ELSE c_mktsegment END AS first_name,
 c_name || ';' || chr(10) || '\ 1' AS address, CASE WHEN c_custkey % 4 = 3 THEN '1990-02-28' END AS birth_date, CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender, CASE WHEN c_custkey % 2 = 1 THEN '5' || c_custkey END AS phone,
 CASE c_custkey % 5 WHEN 0 THEN 'married' WHEN 1 THEN 'widowed' END AS marital_status, CASE WHEN c_custkey % 4 <> 0 AND c_nationkey BETWEEN 1 AND 20 THEN c_nationkey END AS doctor_id, '2020-01-31' AS first_visit_date, CAST(NULL AS VARCHAR) AS last_visit_date,
 CAST(CASE WHEN c_custkey % 6 > 1 THEN (c_custkey % 900) + 0.5 END AS DECIMAL(10,2)) AS visit_fee FROM customer WHERE c_custkey % 34 <> 0""",
)
def _(t: Tables) -> DataFrame:
    doctors = t.nation.where("n_nationkey between 0 and 20").select(F.col("n_nationkey").cast("long").alias("id"))
    rows = T.patients(_read(t, {"fichas": _fichas(t)}).tables["fichas"], doctors).rows
    days = [_day(c).alias(c) for c in ("birth_date", "first_visit_date", "last_visit_date")]
    return rows.select("source_pk", "doc_type", "last_name", "first_name", "address", days[0], "gender", "phone", "marital_status", F.col("doctor_id").cast("int").alias("doctor_id"), *days[1:], "visit_fee")


@query(
    "load_patients_events",
    """WITH c AS (SELECT c_custkey % 34 = 0 AS nameless, c_custkey % 5 = 2 AS odd, c_custkey % 4 <> 0 AND NOT (c_nationkey BETWEEN 1 AND 20) AS lost FROM customer)
 SELECT 'error' AS type, 'first and last name are both blank' AS message, count(*) AS n FROM c WHERE nameless UNION ALL SELECT 'warning', 'unknown marital status', count(*) FROM c WHERE NOT nameless AND odd UNION ALL SELECT 'warning', 'unknown doctor', count(*) FROM c WHERE NOT nameless AND lost""",
)
def _(t: Tables) -> DataFrame:
    doctors = t.nation.where("n_nationkey between 0 and 20").select(F.col("n_nationkey").cast("long").alias("id"))
    return T.patients(_read(t, {"fichas": _fichas(t)}).tables["fichas"], doctors).audit.groupBy("type", "message").agg(F.count("*").alias("n"))


def _turnos(t: Tables) -> DataFrame:
    k, word = F.col("p_partkey"), F.split("p_name", " ")[0]
    name = F.when(k % 3 == 0, word).when(k % 3 == 1, F.concat(F.substring(word, 1, 2), F.expr("substring(split(p_name, ' ')[0], 4)"))).otherwise(F.concat(word, F.lit("x")))
    day = F.when(k % 4 == 0, "0000-00-00").when(k % 4 == 1, "2024-02-30").when(k % 4 == 2, "3/4/2024").otherwise("2024-02-29")
    return t.part.select(
        k.alias("Turno_id"), name.alias("Turno_paciente"), F.col("p_size").alias("Turno_motivoid"), (k % 4).alias("Turno_doctor"), day.alias("Turno_fecha"), F.when(k % 9 != 0, F.col("p_size")).alias("Turno_hora"),
        (k % 6).alias("Turno_estado"), F.when(k % 2 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit("' "))).alias("Turno_detalle"), F.lit("").alias("Turno_telefono"), F.lit(3).alias("Turno_obrasocialid"),
    )


def _people(t: Tables) -> DataFrame:
    return with_ids(t.part.select(F.split("p_name", " ")[0].alias("last_name"), F.lit("").alias("first_name")).distinct(), "last_name")


@query(
    "load_appointments",
    _LAST_SQL
    + """ SELECT CAST(p_partkey AS VARCHAR) AS source_pk, CASE WHEN a.outcome = 'auto_linked' THEN a.id END AS patient_id, CAST(p_size AS BIGINT) AS reason_id, p_partkey % 4 AS doctor_id, CASE WHEN p_partkey % 4 = 3 THEN '2024-02-29' END AS date,
 CAST(CASE WHEN p_partkey % 9 <> 0 AND p_size <= 30 AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_size) THEN p_size END AS BIGINT) AS schedule_id, CAST(3 AS BIGINT) AS insurance_id,
 CASE p_partkey % 6 WHEN 1 THEN 'confirmed' WHEN 2 THEN 'completed' WHEN 3 THEN 'cancelled' ELSE 'pending' END AS status, CASE WHEN p_partkey % 2 = 1 THEN ' ' || p_name || ''' ' END AS notes FROM part JOIN a ON a.input_id = p_partkey""",
)
def _(t: Tables) -> DataFrame:
    schedules = t.supplier.where("s_suppkey <= 30").select(F.col("s_suppkey").alias("id"))
    rows = T.appointments(_read(t, {"inst_turnos": _turnos(t)}).tables["inst_turnos"], _people(t), schedules, SQL_SCORER).rows
    return rows.select("source_pk", "patient_id", "reason_id", "doctor_id", _day("date").alias("date"), "schedule_id", "insurance_id", "status", "notes")


@query(
    "load_linkage_events",
    _LAST_SQL + " SELECT outcome AS type, count(*) AS n FROM a GROUP BY outcome UNION ALL SELECT 'warning', count(*) FROM a WHERE outcome <> 'auto_linked'",
)
def _(t: Tables) -> DataFrame:
    audit = T.appointments(_read(t, {"inst_turnos": _turnos(t)}).tables["inst_turnos"], _people(t), t.supplier.select(F.col("s_suppkey").alias("id")), SQL_SCORER).audit
    return audit.where("details is not null").groupBy("type").agg(F.count("*").alias("n"))


def _cirugias(t: Tables) -> DataFrame:
    k, words = F.col("p_partkey"), F.split("p_name", " ")
    values = {
        "id_cirugia": k, "apellido": words[0], "nombre": words[1], "edad": F.lit(40), "domicilio": F.lit(""), "fecha": F.when(k % 3 == 0, "2024-13-01").otherwise("2024-03-01"),
        "diagnostico": F.when(k % 5 == 0, " ").when(k % 5 == 1, F.lower("p_type")).otherwise(F.col("p_type")), "miembro": F.col("p_brand"), "tecnica1": F.when(k % 4 == 0, "").otherwise(words[1]), "tecnica2": F.upper(words[1]), "tecnica3": F.when(k % 2 == 0, words[0]).otherwise(""), "evolucion": F.when(k % 2 == 0, " fine ").otherwise(" "),
    }
    return t.part.select(*[v.alias(c) for c, v in values.items()])


_SURGERY_SQL = """WITH c AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS l, split_part(p_name, ' ', 2) AS f, p_type, p_brand FROM part)"""


@query(
    "load_surgeries",
    _SURGERY_SQL
    + """ SELECT CAST(p_partkey AS VARCHAR) AS source_pk, CASE WHEN p_partkey % 3 <> 0 THEN '2024-03-01' END AS date, CASE WHEN p_partkey % 5 <> 0 THEN upper(p_type) END AS diagnosis, translate(upper(p_brand), '#', '#') AS body_part, CASE WHEN p_partkey % 2 = 0 THEN 'fine' END AS outcome FROM c""",
)
def _(t: Tables) -> DataFrame:
    rows, lookups = _surgeries(t)
    name = lambda table, into: lookups[table].select(F.col("id").alias(into), X.normalize_text(F.col("value")).alias(f"{into}_name"))
    found = rows[0].rows.join(name("surgery_diagnoses", "diagnosis_id"), "diagnosis_id", "left").join(name("body_parts", "body_part_id"), "body_part_id", "left")
    return found.select("source_pk", _day("date").alias("date"), F.col("diagnosis_id_name").alias("diagnosis"), F.col("body_part_id_name").alias("body_part"), "outcome")


def _surgeries(t: Tables):
    source = _read(t, {"cirugias": _cirugias(t)}).tables["cirugias"]
    lookups = {table: with_ids(words, "value") for table, words in T.surgery_lookups(source).items()}
    people = with_ids(t.part.select(F.split("p_name", " ")[0].alias("last_name"), F.split("p_name", " ")[1].alias("first_name")).distinct(), "last_name", "first_name")
    return T.surgeries(source, people, lookups, SQL_SCORER), lookups


@query(
    "load_surgery_techniques",
    _SURGERY_SQL
    + """, u AS (SELECT p_partkey, upper(f) AS technique, CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END AS order_index FROM c UNION ALL SELECT p_partkey, upper(l), 3 FROM c WHERE p_partkey % 2 = 0)
 SELECT CAST(p_partkey AS VARCHAR) AS source_pk, technique, min(order_index) AS order_index FROM u GROUP BY p_partkey, technique""",
)
def _(t: Tables) -> DataFrame:
    (_, applied), lookups = _surgeries(t)
    names = lookups["surgery_techniques"].select(F.col("id").alias("technique_id"), X.normalize_text(F.col("value")).alias("technique"))
    return applied.join(names, "technique_id").select("source_pk", "technique", "order_index")


def _historia(t: Tables) -> DataFrame:
    notes = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.concat(F.lit("a<br>"), "o_orderpriority", F.lit("< BR />b")))
    day = F.when(F.col("o_orderkey") % 10 == 0, "0000-00-00").otherwise(_day("o_orderdate"))
    return t.orders.select(F.col("o_custkey").alias("idHistoriaClinica"), day.alias("fechaConsulta"), notes.alias("datos"))


@query(
    "load_clinical_records",
    """SELECT o_custkey || ':' || CASE WHEN o_orderkey % 10 = 0 THEN '0000-00-00' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS source_pk, o_custkey + 1000 AS patient_id, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS visit_date,
 CASE WHEN o_orderkey % 4 <> 0 THEN 'a' || chr(10) || o_orderpriority || chr(10) || 'b' END AS notes, CAST(c_acctbal AS DECIMAL(10,2)) AS visit_fee FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 9 <> 0""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.where("c_custkey % 9 <> 0").select(_text("c_custkey").alias("legacy_id"), (F.col("c_custkey") + 1000).alias("patient_id"), F.col("c_acctbal").cast("decimal(10,2)").alias("visit_fee"))
    return T.clinical_records(_read(t, {"historiaclinica": _historia(t)}).tables["historiaclinica"], people).rows.select("source_pk", "patient_id", _day("visit_date").alias("visit_date"), "notes", "visit_fee")


def _caja(t: Tables) -> DataFrame:
    k, amount = F.col("o_orderkey"), F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    income = F.when(k % 11 == 0, "0").when((F.col("o_orderstatus") == "F") | (k % 13 == 0), amount).otherwise("")
    expense = F.when(k % 11 == 0, " ").when((F.col("o_orderstatus") != "F") | (k % 13 == 0), amount).otherwise("0")
    return t.orders.select(k.alias("idCaja"), F.when(k % 10 == 0, "0000-00-00").otherwise(_day("o_orderdate")).alias("fechaCaja"), F.when(k % 9 == 0, " ").otherwise(F.concat(F.lit(" "), "o_orderpriority")).alias("conceptoCaja"), income.alias("ingresosCaja"), expense.alias("egresosCaja"))


@query(
    "load_cash_entries",
    """SELECT CAST(o_orderkey AS VARCHAR) AS source_pk, strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderkey % 9 <> 0 THEN ' ' || o_orderpriority END AS description, CAST(o_totalprice AS DECIMAL(10,2)) AS amount, CASE WHEN o_orderstatus = 'F' THEN 'income' ELSE 'expense' END AS type
 FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""",
)
def _(t: Tables) -> DataFrame:
    return T.cash_entries(_read(t, {"caja": _caja(t)}).tables["caja"]).rows.select("source_pk", _day("date").alias("date"), "description", "amount", "type")


@query(
    "load_reference_tables",
    """WITH d AS (SELECT s_suppkey AS id, s_suppkey % 40 AS k, s_suppkey % 2 = 0 AS active FROM supplier), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS place FROM d)
 SELECT CAST(id AS VARCHAR) AS source_id, CASE WHEN k = 7 THEN 'warning' WHEN k < 3 OR place > 1 THEN 'reused' WHEN id = 5 THEN 'error' ELSE 'migrated' END AS type FROM r""",
)
def _(t: Tables) -> DataFrame:
    """Names that repeat in the source, stand in the target, lack, and an id that the target gives to another name."""
    k = F.col("s_suppkey") % 40
    source = t.supplier.select(F.col("s_suppkey").alias("Obrasoc_id"), F.when(k == 7, " ").otherwise(F.concat(F.lit(" Plán - "), F.lpad(k.cast("string"), 2, "0"))).alias("Obrasoc_texto"), (F.col("s_suppkey") % 2).alias("Obrasoc_estado"))
    have = t.supplier.where("s_suppkey < 3").select((F.col("s_suppkey") + 100000000).alias("id"), F.concat(F.lit("PLAN - 0"), "s_suppkey").alias("name")).unionByName(t.region.limit(1).select(F.lit(5).cast("long").alias("id"), F.lit("another").alias("name")))
    return T.reference_table(_read(t, {"inst_obrasoc": source}).tables["inst_obrasoc"], "inst_obrasoc", have).audit.select("source_id", "type")


def _horarios(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(k.alias("Horarios_id"), F.format_string("%02d:%02d:00", k % 24, (k % 4) * 15).alias("Horarios_hora"), F.when(k % 5 == 4, 7).otherwise(k % 5 % 3).alias("Horarios_estado"))


@query(
    "seed_schedules",
    """WITH s AS (SELECT s_suppkey AS id, s_suppkey % 5 % 3 + 1 AS doctor_id, printf('%02d:%02d', s_suppkey % 24, (s_suppkey % 4) * 15) AS time_slot FROM supplier WHERE s_suppkey % 5 <> 4)
 SELECT min(id) AS id, doctor_id, time_slot, true AS is_available FROM s GROUP BY doctor_id, time_slot""",
)
def _(t: Tables) -> DataFrame:
    return T.seed_schedules(_read(t, {"inst_horarios": _horarios(t)}).tables["inst_horarios"])


@query(
    "verify_schedules",
    """SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE WHEN s_suppkey % 5 <> 4 AND s_suppkey <= 60 THEN 'reused' ELSE 'excluded' END AS type, CASE WHEN s_suppkey % 5 = 4 THEN 'mapping_error: unknown state' WHEN s_suppkey > 60 THEN 'not in the target' ELSE '' END AS message FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    return T.schedules(_read(t, {"inst_horarios": _horarios(t)}).tables["inst_horarios"], t.supplier.where("s_suppkey <= 60").select(F.col("s_suppkey").alias("id"))).audit.select("source_id", "type", "message")


@query("payload_hash_rows", """SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"note":' || CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '"a\\"b"' END || '}') AS payload_hash FROM customer""")
def _(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 1, 'a"b').alias("note"))
    return rows.select("c_custkey", P.payload_hash("note", "c_nationkey", "c_name", "c_mktsegment").alias("payload_hash"))


# The whole load --------------------------------------------------------------


def person(k: Column, first: bool) -> Column:
    """Ten letters for a last name and eight for a first name, unlike those of other keys."""
    return F.translate(F.substring(F.md5(k.cast("string")), 11 if first else 1, 8 if first else 10), "0123456789", "ghijklmnop")


_COUNTS_SQL = """SELECT 'patients' AS name, count(*) AS n FROM customer WHERE c_custkey % 34 <> 0
 UNION ALL SELECT 'appointments', count(*) FROM part WHERE p_partkey % 4 = 3
 UNION ALL SELECT 'surgeries', count(*) FROM part WHERE p_partkey % 3 <> 0
 UNION ALL SELECT 'surgery_diagnoses', count(DISTINCT upper(p_type)) FROM part WHERE p_partkey % 5 <> 0
 UNION ALL SELECT 'body_parts', count(DISTINCT p_brand) FROM part
 UNION ALL SELECT 'surgery_techniques', count(DISTINCT w) FROM (SELECT upper(split_part(p_name, ' ', 2)) AS w FROM part UNION SELECT upper(split_part(p_name, ' ', 1)) FROM part WHERE p_partkey % 2 = 0)
 UNION ALL SELECT 'surgery_applied_techniques', count(*) FROM (SELECT p_partkey, upper(split_part(p_name, ' ', 2)) AS w FROM part WHERE p_partkey % 3 <> 0 UNION SELECT p_partkey, upper(split_part(p_name, ' ', 1)) FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0)
 UNION ALL SELECT 'cash_entries', count(*) FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 10 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
 UNION ALL SELECT 'clinical_records', count(*) FROM (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderkey % 10 <> 0 AND o_custkey % 34 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer))
 UNION ALL SELECT 'schedules', count(*) FROM (SELECT DISTINCT s_suppkey % 5 % 3, s_suppkey % 24, s_suppkey % 4 FROM supplier WHERE s_suppkey % 5 <> 4)"""


def legacy_tables(t: Tables) -> dict[str, DataFrame]:
    """Patients, visits, surgeries, cash book and schedules of the old system, made of the star schema."""
    people = _fichas(t).withColumns({"apellido": F.when(F.col("idFicha") % 17 == 0, " ").otherwise(person(F.col("idFicha"), False)), "nombre": F.when(F.col("idFicha") % 34 == 0, "").otherwise(person(F.col("idFicha"), True))})
    visits = _turnos(t).withColumn("Turno_paciente", person(F.col("Turno_id"), False)).withColumn("Turno_fecha", F.when(F.col("Turno_id") % 4 == 3, "2024-02-29").otherwise("0000-00-00"))
    return {"fichas": people, "inst_turnos": visits, "cirugias": _cirugias(t), "caja": _caja(t), "inst_horarios": _horarios(t), "historiaclinica": _historia(t)}


def load(t: Tables, tables: dict[str, DataFrame]) -> tuple[TableStore, dict]:
    """The target that a load of a dump of the tables fills, and its report."""
    target = shared_path(t.spark, "target")
    done = Pipeline(t.spark, PipelineConfig(dump=dump_of(t.spark, tables), target=target, reports=shared_path(t.spark, "reports"))).run()
    if not done.success:
        raise RuntimeError(done.error)
    return TableStore(t.spark, target), done.report


@query("load_counts", _COUNTS_SQL)
def _(t: Tables) -> DataFrame:
    """A whole load of a dump of six tables, and what the target holds then."""
    store, _ = load(t, legacy_tables(t))
    names = ("patients", "appointments", "surgeries", "surgery_diagnoses", "body_parts", "surgery_techniques", "surgery_applied_techniques", "cash_entries", "schedules", "clinical_records")
    counted = [store.read(name, SCHEMAS[name]).agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name in names]
    out = counted[0]
    for df in counted[1:]:
        out = out.unionByName(df)
    return out


@query("stream_loads_once", "SELECT p_name || ' ' || p_partkey AS name, CAST(1 AS BIGINT) AS n, CAST((SELECT count(*) FROM part) AS BIGINT) AS last_id FROM part")
def _(t: Tables) -> DataFrame:
    """Two thirds of the parts arrive, then two thirds again, of which one has come before."""
    source, state, store = shared_path(t.spark, "arrivals"), shared_path(t.spark, "state"), TableStore(t.spark, shared_path(t.spark, "target"))
    rows = t.part.select(_text("p_partkey").alias("source_pk"), F.sha2("p_name", 256).alias("payload_hash"), F.concat_ws(" ", "p_name", _text("p_partkey")).alias("name"))
    for left_out in (2, 0):
        rows.where(F.col("source_pk").cast("long") % 3 != left_out).write.mode("append").parquet(source)
        load_stream(t.spark.readStream.schema(rows.schema).parquet(source), store, "part", "names", "id long, name string", state).awaitTermination()
    found = store.read("names", "id long, name string")
    return found.groupBy("name").agg(F.count("*").alias("n")).join(F.broadcast(found.agg(F.max("id").alias("last_id"))))
