"""A small invented practice, loaded twice."""

import json
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwork.operators.constraints import Constraints
from loomwork.operators.lookups import first_spelling, in_order, vocabulary, with_ids
from loomwork.operators.upsert import upsert
from loomwork.plans import analytics as A
from loomwork.plans import ledger as L
from loomwork.plans import report as R
from loomwork.plans.config import PipelineConfig, load_config
from loomwork.plans.pipeline import SCHEMAS, Pipeline
from loomwork.plans.store import StoreConflict, TableStore
from loomwork.streaming.incremental import load_stream

COLUMNS = {
    "caja": "idCaja fechaCaja conceptoCaja ingresosCaja egresosCaja",
    "cirugias": "id_cirugia apellido nombre edad domicilio fecha diagnostico miembro tecnica1 tecnica2 tecnica3 evolucion",
    "fichas": "idFicha tipoDoc documento apellido nombre domicilio departamento provincia fechaNac sexo obraSocial nroObraSocial telefono eMail codPostal estadoCivil profesional fuente lugarTrabajo tipoTrabajo trabajoConyuge tipoTrabajoConyuge primerConsulta ultimaConsulta diagnostico valorConsulta",
    "historiaclinica": "idHistoriaClinica fechaConsulta datos",
    "inst_doctor": "Doctor_id Doctor_nombre Doctor_extra",
    "inst_horarios": "Horarios_id Horarios_hora Horarios_estado",
    "inst_motivo": "Motivo_id Motivo_texto Motivo_estado",
    "inst_obrasoc": "Obrasoc_id Obrasoc_texto Obrasoc_estado",
    "inst_turnos": "Turno_id Turno_paciente Turno_motivoid Turno_doctor Turno_fecha Turno_hora Turno_estado Turno_detalle Turno_telefono Turno_obrasocialid",
    "medias": "id",
    "extra": "id",
}


def patient(key, last, first, **more):
    row = {"idFicha": key, "apellido": last, "nombre": first, "sexo": "F", "telefono": "0", "estadoCivil": "", "profesional": "1", "fechaNac": "0000-00-00", "valorConsulta": "150"} | more
    return [row.get(c, "") for c in COLUMNS["fichas"].split()]


ROWS = {
    "caja": [[1, "2024-01-01", "fee", "100,50", "0"], [2, "2024-01-02", "rent", "", "80"], [3, "0000-00-00", "x", "1", "0"], [4, "2024-01-03", "none", "0", "0"], [5, "2024-01-03", "both", "1", "2"], [6, "2024-01-04", " ", "5", "0"], [7, "2024-01-05", "back", "-5", "0"]],
    "fichas": [patient(1, "Moreno", "Lucía"), patient(2, "Peña", "Juan", sexo="M", estadoCivil="Z", profesional="9"), patient(3, " ", ""), patient(4, "Moreno", "Marta")],
    "cirugias": [[1, "Pena", "Juan", 40, "", "2024-02-01", "Hernia", "Pierna", "Laser", "LÁSER", "Corte", "ok"], [2, "Nobody", "Else", 1, "", "2024-13-01", " hernia ", "", "", "", "", ""]],
    "historiaclinica": [[1, "2024-01-05", "a<br>b"], [1, "2024-01-06", ""], [99, "2024-01-06", "lost"]],
    "inst_doctor": [[1, "Dr One", "skin"], [2, "dr. one", ""], [3, "", ""]],
    "inst_horarios": [[1, "08:00", 0], [2, "08:15", 7]],
    "inst_motivo": [[1, "Control", 1]],
    "inst_obrasoc": [[1, "Care", 1], [2, "Sure", 0]],
    "inst_turnos": [[1, "Peña", 1, 1, "2024-03-01", 1, 2, "note", "", 1], [2, "Moreno", 1, 1, "2024-03-01", 5, 9, "", "", 1], [3, "Peña", 1, 1, "0000-00-00", 1, 0, "", "", 1]],
    "medias": [[1]],
    "extra": [[1]],
}


def dump(folder: Path, rows) -> str:
    quote = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    out = []
    for table, names in COLUMNS.items():
        out.append(f"CREATE TABLE `{table}` (\n" + ",\n".join(f"  `{c}` text" for c in names.split()) + "\n);\n")
        out += [f"INSERT INTO `{table}` VALUES ({','.join(map(quote, r))});\n" for r in rows[table]]
    path = folder / "dump.sql"
    path.write_text("".join(out))
    return f"file://{path}"


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    target = f"file://{folder}/target"
    config = PipelineConfig(dump=dump(folder, ROWS), target=target, reports=f"file://{folder}/reports")
    first = Pipeline(spark, config).run()
    assert first.success, first.error
    changed = ROWS | {"historiaclinica": [[1, "2024-01-05", "other"], *ROWS["historiaclinica"][1:]]}
    dump(folder, changed)
    second = Pipeline(spark, config).run()
    assert second.success, second.error
    return TableStore(spark, target), first, second


def table(store, name):
    return [r.asDict() for r in store.read(name, SCHEMAS[name]).collect()]


def test_entities(runs):
    store, first, _ = runs
    people = {r["last_name"] + r["first_name"]: r for r in table(store, "patients")}
    assert set(people) == {"MorenoLucía", "PeñaJuan", "MorenoMarta"}
    assert (people["PeñaJuan"]["gender"], people["PeñaJuan"]["doctor_id"], people["MorenoLucía"]["doctor_id"], people["MorenoLucía"]["phone"]) == ("male", None, 1, None)
    assert [(r["id"], r["name"]) for r in table(store, "doctors")] == [(1, "Dr One")]
    assert sorted((str(r["amount"]), r["type"]) for r in table(store, "cash_entries")) == [("100.50", "income"), ("80.00", "expense")]
    records = table(store, "clinical_records")
    assert sorted((r["notes"] or "", str(r["visit_fee"])) for r in records) == [("", "150.00"), ("a\nb", "150.00")]
    visits = {r["status"]: r for r in table(store, "appointments")}
    assert [(r["id"], r["doctor_id"], r["time_slot"]) for r in table(store, "schedules")] == [(1, 1, "08:00")]
    assert (visits["completed"]["schedule_id"], visits["pending"]["schedule_id"]) == (1, None)
    assert all(r["created_at"] == r["updated_at"] is not None for r in people.values())
    assert len(visits) == 2 and visits["completed"]["patient_id"] == people["PeñaJuan"]["id"] and visits["pending"]["patient_id"] is None
    (surgery,) = table(store, "surgeries")
    assert surgery["patient_id"] == people["PeñaJuan"]["id"]
    assert sorted(r["order_index"] for r in table(store, "surgery_applied_techniques")) == [1, 3]
    assert len(table(store, "surgery_techniques")) == 2 and len(table(store, "surgery_diagnoses")) == 1


def test_report(runs):
    _, first, second = runs
    total = next(r for r in first.report["tables"] if r["table"] == "total")
    assert total["migrated"] > 10 and first.report["excluded_tables"] == ["medias"] and first.report["unknown_tables"] == ["extra"]
    cash = next(r for r in first.report["tables"] if r["table"] == "caja")
    assert (cash["migrated"], cash["omitted"], cash["excluded"]) == (2, 1, 4)
    assert json.loads(Path(first.report_paths[0].removeprefix("file:")).read_text())["tables"] == first.report["tables"]
    assert "| caja |" in Path(first.report_paths[1].removeprefix("file:")).read_text()
    again = {r["table"]: r for r in second.report["tables"]}
    assert again["caja"]["migrated"] == 0 and again["caja"]["reused"] == 2
    assert any("has changed" in e["message"] for e in second.report["examples"]["warning"])
    assert first.report["matching"] == {"auto_linked": 3, "manual_review": 1, "no_match": 1}
    (review,) = first.report["examples"]["manual_review"]
    assert review["details"]["name"] == "MORENO" or len(review["details"]["candidates"]) == 2
    text = Path(first.report_paths[1].removeprefix("file:")).read_text()
    assert "## Patient matching" in text and "Candidates: " in text and "## No match" in text


def test_every_event_stands_beside_the_report(spark, runs):
    _, first, _ = runs
    events = spark.read.schema(R.EVENTS).json(first.report["files"]["events"])
    assert {r["type"]: r["count"] for r in events.groupBy("type").count().collect()} == first.report["events"]


def crash(store, after):
    """Lets ``after`` commits through and then fails, as a lost driver would, with the files written but no manifest."""
    publish, left = store._publish, [after]

    def stopped(commit):
        if not left[0]:
            raise RuntimeError("the driver was lost")
        left[0] -= 1
        publish(commit)

    store._publish = stopped


def test_a_load_that_stops_between_any_two_commits_loads_each_row_once(spark, tmp_path):
    path = dump(tmp_path, ROWS)
    whole = TableStore(spark, f"file://{tmp_path}/whole")
    assert Pipeline(spark, PipelineConfig(dump=path, target=whole.root, reports=f"file://{tmp_path}/r")).run().success
    names = ("patients", "appointments", "cash_entries")
    target = f"file://{tmp_path}/target"
    for after in (3, 1, 1):
        pipeline = Pipeline(spark, PipelineConfig(dump=path, target=target, reports=f"file://{tmp_path}/r"))
        crash(pipeline.store, after)
        assert not pipeline.run().success
    assert Pipeline(spark, PipelineConfig(dump=path, target=target, reports=f"file://{tmp_path}/r")).run().success
    store = TableStore(spark, target)
    for name in names:
        got, want = ([{k: v for k, v in r.items() if not k.endswith("_at")} for r in table(s, name)] for s in (store, whole))
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert store.read(L.TABLE, L.SCHEMA).count() == whole.read(L.TABLE, L.SCHEMA).count()


def test_tables_of_a_commit_change_together(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    rows = spark.range(3)
    with pytest.raises(RuntimeError), store.commit() as c:
        c.append("a", rows)
        raise RuntimeError
    assert store.read("a", "id long").isEmpty()
    with store.commit() as c:
        c.append("a", rows)
        c.append("b", rows)
    late = store.commit()
    with pytest.raises(StoreConflict), late as c:
        c.append("a", rows)
        store.append("b", rows)
    assert (store.read("a", "id long").count(), store.read("b", "id long").count()) == (3, 6)
    # A manifest that its writer did not finish does not count.
    torn = Path(f"{tmp_path}/store/_manifests/{store._newest()[0] + 1:012d}.json")
    torn.write_text('{"a": [')
    assert store.read("a", "id long").count() == 3
    store.overwrite("a", spark.range(1))
    assert store.read("a", "id long").count() == 1 and store.read("b", "id long").count() == 6
    store.truncate("a", "b")
    assert store.read("b", "id long").isEmpty()


def test_failures_are_results(spark, tmp_path):
    found = Pipeline(spark, PipelineConfig(dump=f"file://{tmp_path}/none.sql", target=f"file://{tmp_path}/t")).run()
    assert not found.success and found.error


def test_reset(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    ledger = L.Ledger(store)
    row = spark.createDataFrame([("t", "1", "x", 5, "migrated", "h")], "source_table string, source_pk string, target_table string, target_id long, status string, payload_hash string").withColumn("migrated_at", F.current_timestamp())
    ledger.record(row)
    ledger.record(row.withColumn("target_id", F.lit(6).cast("long")).withColumn("migrated_at", F.expr("current_timestamp() + interval 1 day")))
    assert [r.target_id for r in ledger.entries().collect()] == [6]
    ledger.reset("none")
    assert ledger.entries().count() == 1
    ledger.reset("log-only")
    assert ledger.entries().count() == 0
    with pytest.raises(ValueError):
        ledger.reset("some")


def test_config():
    base = {"LOOMWORK_DUMP": "d", "LOOMWORK_TARGET": "t?a=b", "LOOMWORK_CONFIDENCE": "0.9"}
    config = load_config(["--confidence=0.95", "--dump-path", "e", "--db-url=u?x=y", "--minimum="], base)
    assert (config.confidence, config.dump, config.target, config.minimum) == (0.95, "e", "u?x=y", 0.75)
    for argv in (["--confidence=2"], ["--batch=0"], ["--reset=all"], ["--odd=1"], ["--margin=x"]):
        with pytest.raises(ValueError):
            load_config(argv, base)
    with pytest.raises(ValueError):
        load_config([], {})


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "a", " A.", None), (2, "b", "á", "c"), (3, " ", "", "b ")], "k int, x string, y string, z string")
    words = first_spelling(vocabulary(rows, "x", "y", "z"), "value")
    assert sorted((r.norm, r.value, r.spellings) for r in words.collect()) == [("A", "A.", 3), ("B", "b", 1), ("C", "c", 1)]
    assert sorted(tuple(r) for r in in_order(rows, "k", "x", "y", "z").where("k = 2").collect()) == [(2, "b", 1), (2, "c", 3), (2, "á", 2)]
    ids = with_ids(spark.range(1000).select(F.col("id").alias("v")), "v", start=7)
    assert ids.where("id <> v + 8").count() == 0 and ids.count() == 1000
    assert with_ids(spark.range(0), "id", name="n").count() == 0


def test_ids_of_many_wide_rows_are_unique_and_without_gaps(spark, tmp_path):
    rows = spark.range(1_000_000).select(F.hash("id").alias("v"), *[F.concat(F.lit(f"column {k} "), F.col("id").cast("string")).alias(f"c{k}") for k in range(4)])
    with_ids(rows, "v", start=75).write.parquet(f"file://{tmp_path}/ids")
    found = spark.read.parquet(f"file://{tmp_path}/ids")
    assert found.agg(F.count("id"), F.countDistinct("id"), F.min("id"), F.max("id")).first()[:] == (1_000_000, 1_000_000, 76, 1_000_075)
    steps = found.select("v", F.lead("v").over(Window.partitionBy((F.col("id") / 1000).cast("long")).orderBy("id")).alias("after"))
    assert steps.where("after < v").isEmpty()


def test_constraints(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, None, 9)], "id int, name string, ref int")
    rules = Constraints(not_null=["name"], checks={"small": F.col("id") < 3}, unique={"name": ["name"]}, references={"ref": (spark.createDataFrame([(1,)], "k int"), "k")}, order=["id"])
    good, bad = rules.split(rows)
    assert [r.id for r in good.collect()] == [1]
    assert {r.id: sorted(r.violations) for r in bad.collect()} == {2: ["unique:name"], 3: ["check:small", "foreign_key:ref", "not_null:name"]}


def test_report_helpers():
    assert R.duration(3725) == "1h 2m 5s" and R.escaped("a|b") == "a\\|b"


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "id int, v string, w string").withColumns({c: F.lit("2024-01-01").cast("timestamp") for c in ("created_at", "updated_at")})
    new = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "id int, v string")
    found = upsert(old, new, "id", at=F.lit("2024-02-02").cast("timestamp")).orderBy("id").collect()
    assert [(r.id, r.v, r.w, r.created_at.month, r.updated_at.month) for r in found] == [(1, "a", None, 1, 1), (2, None, "x", 1, 2), (3, "c", "y", 1, 1), (4, "d", None, 2, 2)]


def test_searches(spark):
    people = spark.createDataFrame([(1, "Peña", "José", "12.345"), (2, "Pena", "Ana", "99"), (3, None, "josefa", None)], "id int, last string, first string, doc_number string")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(A.search_names(people, " jose", "last", "first")) == [1, 3] and ids(A.search_names(people, "pen an", "last", "first")) == [2]
    assert ids(A.search_names(people, " - ", "last", "first")) == [] and ids(A.search_document(people, "12345")) == [1]


def test_a_stream_that_stops_before_its_commit_loads_each_row_once(spark, tmp_path):
    schema = "source_pk string, payload_hash string, name string"
    spark.createDataFrame([(x, "h", x.upper()) for x in "abc"], schema).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    for after in (0, 1):
        store = TableStore(spark, f"file://{tmp_path}/store")
        crash(store, after)
        query = load_stream(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in"), store, "letters", "names", "id long, name string", f"file://{tmp_path}/state")
        if after:
            query.awaitTermination()
        else:
            with pytest.raises(Exception, match="lost"):
                query.awaitTermination()
    assert sorted((r.id, r.name) for r in store.read("names", "id long, name string").collect()) == [(1, "A"), (2, "B"), (3, "C")]
    assert store.read(L.TABLE, L.SCHEMA).count() == 3


def test_stream_loads_each_row_once(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    schema = "source_pk string, payload_hash string, name string"
    for part in (["a", "b"], ["b", "c"]):
        spark.createDataFrame([(x, "h", x.upper()) for x in part], schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in")
        load_stream(stream, store, "letters", "names", "id long, name string", f"file://{tmp_path}/state").awaitTermination()
    assert sorted((r.id, r.name) for r in store.read("names", "id long, name string").collect()) == [(1, "A"), (2, "B"), (3, "C")]


def test_many_batches_leave_few_versions_and_no_stage(spark, tmp_path, monkeypatch):
    from loomwork.streaming import incremental

    monkeypatch.setattr(incremental, "MOST_VERSIONS", 2)
    store = TableStore(spark, f"file://{tmp_path}/store")
    schema = "id long, name string"
    for k in range(5):
        rows = [(f"{i}", f"h{i}", f"n{i}") for i in range(k * 3, k * 3 + 5)]
        spark.createDataFrame(rows, "source_pk string, payload_hash string, name string").write.mode("append").parquet(f"file://{tmp_path}/in")
        stream = spark.readStream.schema("source_pk string, payload_hash string, name string").parquet(f"file://{tmp_path}/in")
        load_stream(stream, store, "letters", "names", schema, f"file://{tmp_path}/state").awaitTermination()
        assert all(len(v) <= 3 for v in store._newest()[1].values())
        assert not (tmp_path / "store" / "_stage").exists()
        for table in ("names", "migration_log"):
            assert len(list((tmp_path / "store" / table).iterdir())) <= 3
    names = store.read("names", schema).collect()
    assert sorted(r.name for r in names) == sorted(f"n{i}" for i in range(17)) and sorted(r.id for r in names) == list(range(1, 18))
    assert store.next_id("names", schema) == 17 == store._newest()[2]["names"]
    # A table whose rows came without a mark is looked at once more.
    store.append("names", spark.createDataFrame([(40, "x")], schema))
    assert store.next_id("names", schema) == 40
