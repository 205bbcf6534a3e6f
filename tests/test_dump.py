import random
import re

import pytest
from pyspark.sql import functions as F

from loomwork.sources.mysqldump import counted_classes, parse_create, parse_mysql_dump, read_mysql_dump, statements, write_extended

# Names of legacy tables and columns; the rows are invented.
DUMP = r"""-- header; with a semicolon
/*!40101 SET NAMES utf8 */;
DROP TABLE IF EXISTS `caja`;
CREATE TABLE `caja` (
  `idCaja` int(11) NOT NULL DEFAULT '0',
  `conceptoCaja` varchar(100) DEFAULT 'a,b',
  `ingresosCaja` decimal(10,2),
  PRIMARY KEY (`idCaja`),
  KEY `k` (`conceptoCaja`)
) ENGINE=MyISAM;
LOCK TABLES `caja` WRITE;
INSERT INTO `caja` VALUES (1,'it\'s; (a, b)\nnext',NULL),(2,'','0'),(-3.5,'x\\',null);
INSERT INTO `caja` (`idCaja`,`conceptoCaja`,`ingresosCaja`) VALUES (4,'tab\t','12,5');
UNLOCK TABLES;
CREATE TABLE IF NOT EXISTS other (a int, b int);
INSERT INTO other VALUES (1,2);
CREATE TABLE `medias` (`id` int);
INSERT INTO `medias` VALUES (1);
INSERT INTO `nowhere` VALUES (1);
"""


def write(tmp_path, text):
    path = tmp_path / "dump.sql"
    path.write_text(text, newline="")
    return f"file://{path}"


def test_tables_and_values(spark, tmp_path):
    path = write(tmp_path, DUMP)
    dump = read_mysql_dump(spark, path)
    assert (dump.in_scope, dump.excluded, dump.unknown) == (["caja"], ["medias"], ["other"])
    assert dump.tables["caja"].columns == ["idCaja", "conceptoCaja", "ingresosCaja"]
    rows = [tuple(r) for r in dump.tables["caja"].orderBy("idCaja").collect()]
    assert rows == [("-3.5", "x\\", None), ("1", "it's; (a, b)\nnext", None), ("2", "", "0"), ("4", "tab\\t", "12,5")]
    assert [tuple(r) for r in dump.tables["other"].collect()] == [("1", "2")]
    assert parse_mysql_dump(spark, path) == {"tables": ["caja", "other"], "records": 5}


def test_a_row_of_another_length_stops_the_read(spark, tmp_path):
    path = write(tmp_path, "CREATE TABLE t (\n a int,\n b int\n);\nINSERT INTO t VALUES (1,2),(3);\n")
    with pytest.raises(Exception, match="t: a row has 1 values for 2 columns"):
        read_mysql_dump(spark, path).tables["t"].collect()


def test_long_literals_do_not_exhaust_the_stack(spark, tmp_path):
    text = "x'(,);".replace("'", "\\'") * 20_000
    path = write(tmp_path, f"CREATE TABLE t (a int, b text);\nINSERT INTO t VALUES (1,'{text}'),(2,'{text}');\n")
    assert [len(r.b) for r in read_mysql_dump(spark, path).tables["t"].collect()] == [120_000, 120_000]


def test_both_line_ends(spark, tmp_path):
    path = write(tmp_path, DUMP.replace("\n", "\r\n"))
    dump = read_mysql_dump(spark, path)
    assert sorted(dump.tables) == ["caja", "other"] and dump.tables["caja"].columns == ["idCaja", "conceptoCaja", "ingresosCaja"]
    assert parse_mysql_dump(spark, path) == {"tables": ["caja", "other"], "records": 5}
    mixed = DUMP.replace("\n", "\r\n").replace("(2,'','0'),", "(2,'','0');\nINSERT INTO `caja` VALUES ")
    assert parse_mysql_dump(spark, write(tmp_path, mixed)) == {"tables": ["caja", "other"], "records": 5}
    assert parse_mysql_dump(spark, write(tmp_path, mixed.replace("\r\n", "\n"))) == {"tables": ["caja", "other"], "records": 5}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_raw_line_breaks_in_literals(spark, tmp_path, end):
    texts = [f"a;{end}  INSERT INTO t VALUES (9,''x'');{end};{end}b", f";{end}", f"-- no comment;{end}/* nor this", "plain"]
    rows = "".join(f"-- it's a comment;{end}INSERT INTO t VALUES ({k},'{x}');{end}" for k, x in enumerate(texts))
    found = read_mysql_dump(spark, write(tmp_path, f"CREATE TABLE t (a int, b text);{end}{rows}")).tables["t"]
    assert {int(r.a): r.b for r in found.collect()} == dict(enumerate(texts))


@pytest.mark.parametrize("tail", ["INSERT INTO t VALUES (1,'open);\nINSERT INTO t VALUES (2,3);\n", "(1,2);\n", "INSERT INTO t VALUES (1,2) nonsense;\n", "'x';\n"])
def test_what_is_no_statement_stops_the_read(spark, tmp_path, tail):
    path = write(tmp_path, "CREATE TABLE t (a int, b text);\n" + tail)
    with pytest.raises(Exception, match="no statement|no list of values|literal has no end"):
        read_mysql_dump(spark, path).tables["t"].collect()


def test_definitions():
    assert parse_create("CREATE TABLE a (`x y` int, b enum('p,)','q'), UNIQUE KEY u (b))") == ("a", ["x y", "b"])
    assert parse_create("INSERT INTO a VALUES (1)") is None


def scanned(text):
    """Statements of a dump by one walk over its characters: (table, rows as text) in order."""
    out, at, n = [], 0, len(text)

    def literal(k):
        k += 1
        while text[k] != "'":
            k += 2 if text[k] == "\\" else 1
        return k + 1

    def end_of(k, stop):
        depth = 0
        while k < n:
            c = text[k]
            if c == "'":
                k = literal(k)
                continue
            if c == "`":
                k = text.index("`", k + 1) + 1
                continue
            if text.startswith("/*", k):
                k = text.index("*/", k) + 2
                continue
            if c == "#" or text.startswith("-- ", k):
                k = text.index("\n", k) + 1
                continue
            depth += (c == "(") - (c == ")")
            k += 1
            if (stop == ")" and c == ")" and not depth) or (stop == ";" and c == ";"):
                return k
        return n

    while at < n:
        end = end_of(at, ";")
        body = text[at:end]
        at = end
        found = re.search(r"INSERT INTO `?(\w+)`? VALUES ", body)
        if found:
            k, rows = at - len(body) + found.end(), []
            while k < end - 1:
                stop = end_of(k, ")")
                if "(" not in text[k:stop]:
                    break
                rows.append(text[k:stop].lstrip(", \n"))
                k = stop
            out.append((found[1], rows))
    return out


def random_dump(pick):
    pieces = ["it\\'s", "),(", ");\n", "\\\\", "a(b", "-- x", "/* y", "#", "`", " INSERT INTO t VALUES (", "é", "\\)", "plain text", "\n", ";", '"']
    value = lambda: pick.choice([str(pick.randint(-9, 999)), "NULL", "'" + "".join(pick.choice(pieces) for _ in range(pick.randint(0, 5))) + "'"])
    text = "-- head; it's (a), (b)\nCREATE TABLE t (a text, b text);\nCREATE TABLE u (a text, `x'y` text,\n KEY k (a),\n KEY l (`x'y`)\n);\n"
    for _ in range(pick.randint(1, 12)):
        rows = pick.choice([",", ", ", ",\n"]).join(f"({value()},{value()})" for _ in range(pick.choice([1, 1, 3, 40])))
        text += pick.choice(["", "-- it's; a (comment), (here)\n", "/* one's ), ( */ ", "# it's\n", "/*!40000 ALTER TABLE `t` DISABLE KEYS */;\n", "LOCK TABLES `t` WRITE;\n"])
        text += f"INSERT INTO {pick.choice(['t', '`t`', 'u'])} VALUES {rows};" + pick.choice(["\n", "\n", " "])
    return text


def test_blocks_of_any_size_give_the_same_rows(spark, tmp_path):
    pick = random.Random(12)
    for n in range(4):
        text = random_dump(pick)
        folder = tmp_path / str(n)
        folder.mkdir()
        path = write(folder, text)
        want = sorted((t, row) for t, rows in scanned(text) for row in rows)
        for size in (None, max(16, len(text.encode()) // 40)):
            found = statements(spark, path, block_bytes=size)
            got = [(r.table, x) for r in found.where("table is not null").collect() for x in re.findall(r"(?s)\((?:'(?:[^'\\]|\\.)*'|[^'()])*\)", r.statement)]
            assert sorted(got) == want, (n, size)
            assert found.where("statement like 'CREATE%'").count() == 2


def test_one_insert_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("it's \\ ),( "), "id").alias("said"))
    path = f"file://{tmp_path}/dump"
    write_extended(rows.coalesce(1), "t", path)
    size = sum(p.stat().st_size for p in (tmp_path / "dump").glob("part-*"))
    blocks = 20
    dump = read_mysql_dump(spark, path, block_bytes=size // blocks)
    assert sorted(map(tuple, dump.tables["t"].collect())) == sorted(map(tuple, rows.collect()))
    # Lists of values come from all blocks, and none holds more than its block's share.
    parts = statements(spark, path, block_bytes=size // blocks).where("table = 't'")
    held = [len(r.statement) for r in parts.collect()]
    assert len(held) >= blocks and max(held) <= size / blocks + 200
    assert counted_classes(dump).collect()[0].n == 20_000


@pytest.mark.parametrize("text", ["", "\n", "-- only a comment's (text)", "CREATE TABLE t (a int)", "CREATE TABLE t (a int);\nINSERT INTO t VALUES (1)", "CREATE TABLE t (a int);\nINSERT INTO t VALUES (1),(2) ;\n-- done"])
def test_ends_of_files(spark, tmp_path, text):
    path = write(tmp_path, text)
    for size in (None, 16):
        dump = read_mysql_dump(spark, path, block_bytes=size)
        assert sum(df.count() for df in dump.tables.values()) == text.count("(1)") + text.count("(2)")
    cut = write(tmp_path, text[: text.rfind("(") + 2] if "INSERT" in text else "CREATE TABLE t (a int);\nINSERT INTO t VALUES (1")
    with pytest.raises(Exception, match="no list of values"):
        read_mysql_dump(spark, cut, block_bytes=16).tables["t"].collect()
