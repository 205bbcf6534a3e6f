import random
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from loomwork import catalog
from loomwork.functions import parse as P
from loomwork.functions import text as X
from loomwork.functions.similarity import Pool, jaro_winkler_many, upper_bound


def column(spark, values, expression):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x string")
    return [r.y for r in rows.select("k", expression(F.col("x")).alias("y")).orderBy("k").collect()]


# Names of tables and columns of the target model are fixed values; people are invented.
MARKED = ["Jose\u0301", "Nguyễn", "Nguye\u0302\u0303n", "N\u0303andu", "n\u0303andu", "\u1e66a", "Йод", "Άλφα", "\u212bngström", "ŁÓDŹ", "Ǖber", "a\u0323\u0302b"]
NAMES = ["  josé  pérez ", "PEÑA", "peña", "O'Connor-Smith", "A - B", "müller (jr.)", "\t x\n", "", None, "Łódź", "ÀÉÎÕÜ ç"]
NORMAL = ["JOSE PEREZ", "PEÑA", "PEÑA", "OCONNORSMITH", "A  B", "MULLER JR", "X", "", None, "ŁODZ", "AEIOU C"]


def test_normal_form_native_and_exact(spark):
    assert column(spark, NAMES, X.normalize_text) == NORMAL
    assert column(spark, NAMES, X.normalize_text_exact) == NORMAL
    assert column(spark, ["ñandú"], lambda c: X.normalize_text(c, preserve_case=True)) == ["nandu"] == [X.normal_form("ñandú", preserve_case=True)]


def test_marks_go_whether_letters_hold_them_or_not(spark):
    exact = [X.normal_form(x) for x in MARKED]
    assert column(spark, MARKED, X.normalize_text) == exact == column(spark, MARKED, X.normalize_text_exact)
    assert exact[:5] == ["JOSE", "NGUYEN", "NGUYEN", "ÑANDU", "ÑANDU"]
    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)) if unicodedata.decomposition(chr(c))]
    assert column(spark, letters, X.normalize_text) == [X.normal_form(x) for x in letters]


def test_unescape_takes_any_character(spark):
    assert column(spark, ["a\0b", "a\0\\nb", "\\\\\\'", "end\\", "\\\\n", None, "no"], X.unescape_sql) == ["a\0b", "a\0\nb", "\\'", "end\\", "\\n", None, "no"]


def test_lenient_dates_marital_codes_and_fees(spark):
    assert [str(d) if d else None for d in column(spark, ["2024-02-29", " ", "0000-00-00", "1/2/2024", None], P.lenient_date)] == ["2024-02-29", None, None, None, None]
    assert [None if x is None else str(x) for x in column(spark, ["150", "12.345", "12,5", "abc", "", None], P.visit_fee)] == ["150.00", "12.35", "12.00", None, None, None]


def test_trimming_and_markup(spark):
    assert column(spark, ["\t a  ", " \n", None], X.blank_to_null) == ["a", None, None]
    assert column(spark, [" a ", " "], X.keep_unless_blank) == [" a ", None]
    assert column(spark, ["a<br>b<BR/>c< br / >d", ""], X.br_to_newline) == ["a\nb\nc\nd", None]
    assert column(spark, [r"it\'s", r"a\\nb", r"a\nb\rc", r"\t\"", "''"], X.unescape_sql) == ["it's", r"a\nb", "a\nb\rc", r"\t\"", "''"]


def test_dates(spark):
    days = ["2024-02-29", "0000-00-00", " ", None, "2023-13-45", "1/2/2023"]
    assert [str(d) if d else None for d in column(spark, days, P.strict_date)] == ["2024-02-29", None, None, None, None, None]
    assert column(spark, days, P.invalid_date) == [False, False, False, False, True, True]


@pytest.mark.parametrize(("text", "value"), [("12,5", 12.5), ("1,2,3", 1.2), ("12abc", 12.0), ("", 0.0), (None, 0.0), ("abc", 0.0), (" -3.25 ", -3.25), (",5", 0.5)])
def test_decimal_comma(spark, text, value):
    assert column(spark, [text], P.decimal_comma) == [value]


def test_codes(spark):
    assert column(spark, [" m", "F", "x", None], P.gender) == ["male", "female", None, None]
    assert column(spark, ["0", "3", "9", None], P.appointment_status) == ["pending", "cancelled", "pending", "pending"]
    assert column(spark, ["0", "9", None], P.unknown_status) == [False, True, False]
    assert column(spark, ["Married", "S"], P.marital_status) == ["married", None]
    assert column(spark, ["S"], lambda c: P.marital_status(c, {"S": "single"})) == ["single"]
    assert column(spark, ["12x", "0", " ", "abc"], P.doctor_code) == [12, None, None, None]


def test_cash_route(spark):
    rows = spark.createDataFrame([("0000-00-00", 1.0, 0.0), ("d", 0.0, 0.00009), ("d", 1.0, 1.0), ("d", 1.0, 0.0), (None, 0.0, -2.0)], "d string, i double, e double")
    assert [r[0] for r in rows.select(P.cash_route(F.col("d"), F.col("i"), F.col("e"))).collect()] == ["excluded_date", "omitted", "excluded_both", "income", "expense"]


def test_payload_hash_ignores_order_but_not_nulls(spark):
    rows = spark.createDataFrame([("1", None, "x")], "a string, b string, c string")
    one, two, three = rows.select(P.payload_hash("a", "b", "c"), P.payload_hash("c", "a", "b"), P.payload_hash("a", "c")).first()
    assert one == two != three


def jaro_winkler(a, b, floor=False, threshold=0.0):
    """The textbook form, one character at a time."""
    if not a or not b:
        return 0.0
    window, used, left = max(max(len(a), len(b)) // 2 - 1, 0), set(), []
    for i, c in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if j not in used and b[j] == c:
                used.add(j)
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    half = sum(x != b[j] for x, j in zip(left, sorted(used), strict=True))
    t = half // 2 if floor else half / 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = next((k for k in range(4) if k >= min(len(a), len(b)) or a[k] != b[k]), 4)
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > threshold else jaro


def test_jaro_winkler_against_the_textbook():
    pick = random.Random(5)
    words = ["".join(pick.choice("ABCÑ") for _ in range(pick.randint(0, 9))) for _ in range(150)]
    for floor, threshold in ((False, 0.0), (True, 0.7)):
        for a in words[:60]:
            got = jaro_winkler_many(a, Pool(words), floor_transpositions=floor, boost_threshold=threshold)
            want = [jaro_winkler(a, b, floor, threshold) for b in words]
            assert max(abs(g - w) for g, w in zip(got, want, strict=True)) < 1e-12
    assert all((jaro_winkler_many(a, Pool(words)) <= upper_bound(a, Pool(words)) + 1e-12).all() for a in words)
    assert 0.6 * jaro_winkler_many("PEÑA", Pool(["PENA"]))[0] + 0.4 >= 0.92


def test_long_names_are_compared_in_bounded_steps():
    pool = Pool(["AB" * 40_000, *["ABAB" + "C" * k for k in range(2_000)], ""])
    got = jaro_winkler_many("AB" * 300, pool)
    assert got[-1] == 0 and got.argmax() == 0 and abs(got[5] - jaro_winkler("AB" * 300, "ABABCCCC")) < 1e-12
    assert (got <= upper_bound("AB" * 300, pool) + 1e-12).all()


SF = "/root/testdata/sf0.001"


def against_sql(spark, name, table):
    """Rows of a query, equal to those of its SQL."""
    db = duckdb.connect()
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = [tuple(r) for r in catalog.QUERIES[name](spark, SF).collect()]
    assert sorted(got, key=str) == sorted(db.execute(catalog.SQL[name]).fetchall(), key=str)
    return got


def test_histories_are_whole(spark):
    got = against_sql(spark, "history_by_entity", "events")
    assert len(got) == spark.read.parquet(f"{SF}/events.parquet").count()
    assert max(place for *_, place in got) > 3


def test_agendas_are_whole(spark):
    got = against_sql(spark, "agenda_by_day", "orders")
    assert sum(n for *_, n in got) == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert len({day[:7] for _, day, _ in got}) > 1
