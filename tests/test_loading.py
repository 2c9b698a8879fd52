import json
import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.operators import upsert
from ledgerlens.sources import periods, readers, writers
from ledgerlens.streaming import merge as streams

ROW = "k int, ano int, mes int, v int"


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(ROW).parquet(path).select("k", "ano", "mes", "v").collect())


def test_upsert_moves_rows_and_drops_empty_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2024, 1, 10), (2, 2024, 2, 20), (3, 2024, 2, 30), (9, 2023, 5, 1)], ROW)
    upsert.upsert(spark, path, first, ["k"])
    untouched = os.listdir(f"{path}/ano=2023/mes=5")
    batch = spark.createDataFrame([(1, 2024, 2, 11), (4, 2024, 3, 40), (4, 2024, 3, 41)], ROW)
    want = [(1, 2024, 2, 11), (2, 2024, 2, 20), (3, 2024, 2, 30), (4, 2024, 3, 41), (9, 2023, 5, 1)]
    for _ in range(2):  # running a batch twice changes nothing
        upsert.upsert(spark, path, batch, ["k"], order_by=[F.col("v").desc()])
        assert table(spark, path) == want
    assert not os.path.exists(f"{path}/ano=2024/mes=1")
    assert os.listdir(f"{path}/ano=2023/mes=5") == untouched


def test_upsert_repairs_a_half_finished_run(spark, tmp_path):
    """The row already stands in its new folder, its old copy was not removed yet."""
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2024, 1, 10), (1, 2024, 2, 11), (2, 2024, 1, 5)], ROW).write.partitionBy("ano", "mes").parquet(path)
    upsert.upsert(spark, path, spark.createDataFrame([(1, 2024, 2, 11)], ROW), ["k"])
    assert table(spark, path) == [(1, 2024, 2, 11), (2, 2024, 1, 5)]


class Crash(Exception):
    pass


@pytest.mark.parametrize("moment", ["before the rows", "old folders gone", "folders replaced"])
def test_upsert_loses_nothing_in_a_crash(spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "t")
    upsert.upsert(spark, path, spark.createDataFrame([(1, 2024, 1, 10), (2, 2024, 1, 20), (3, 2024, 2, 30)], ROW), ["k"])
    batch = spark.createDataFrame([(1, 2024, 1, 11), (3, 2024, 1, 31)], ROW)
    real = upsert.replace_periods

    def crash(rows, where, names):
        if moment == "before the rows":
            os.remove(f"{where}/_pending/rows/_SUCCESS")
        elif moment == "old folders gone":
            shutil.rmtree(f"{where}/ano=2024/mes=1")
        else:
            real(rows, where, names)
        raise Crash

    monkeypatch.setattr(upsert, "replace_periods", crash)
    with pytest.raises(Crash):
        upsert.upsert(spark, path, batch, ["k"])
    monkeypatch.setattr(upsert, "replace_periods", real)
    upsert.recover(spark, path, batch.schema)
    old = [(1, 2024, 1, 10), (2, 2024, 1, 20), (3, 2024, 2, 30)]
    new = [(1, 2024, 1, 11), (2, 2024, 1, 20), (3, 2024, 1, 31)]
    assert table(spark, path) == (old if moment == "before the rows" else new)
    upsert.upsert(spark, path, batch, ["k"])
    assert table(spark, path) == new
    assert sorted(n for n in os.listdir(path) if n[0] not in "_.") == ["ano=2024"]
    assert os.listdir(f"{path}/ano=2024") == ["mes=1"]


def test_ties_in_a_batch_are_broken_by_the_whole_row(spark):
    rows = [(1, 2024, m, v) for m in (1, 2, 3) for v in range(20)]
    empty = spark.createDataFrame([], ROW)
    got = {
        tuple(upsert.merge_rows(empty, spark.createDataFrame(r, ROW).repartition(5), ["k"]).first())
        for r in (rows, rows[::-1])
    }
    assert len(got) == 1


def test_sequence_makes_the_order_of_batches_irrelevant(spark):
    a = spark.createDataFrame([(1, 2024, 1, 10), (2, 2024, 1, 7)], ROW)
    b = spark.createDataFrame([(1, 2024, 2, 9), (3, 2024, 2, 1)], ROW)
    one = upsert.merge_rows(a, b, ["k"], sequence=["v"])
    two = upsert.merge_rows(b, a, ["k"], sequence=["v"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert (1, 2024, 1, 10) in [tuple(r) for r in one.collect()]


def test_stream_equals_batch(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "t")
    batches = [
        [(1, 2024, 1, 1), (2, 2024, 1, 2)], [(1, 2024, 2, 5), (3, 2024, 2, 1)], [(2, 2024, 1, 1), (3, 2024, 2, 9)],
    ]
    stream = None
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(folder)
        stream = streams.arriving_files(spark, folder, T._parse_datatype_string(ROW), files_per_batch=1)
        streams.merge_stream(
            stream, path, str(tmp_path / "offsets"), ["k"], sequence=["v"]
        ).awaitTermination()
    flat = spark.createDataFrame([r for b in batches for r in b], ROW)
    want = upsert.merge_rows(flat.limit(0), flat, ["k"], sequence=["v"])
    assert table(spark, path) == sorted(tuple(r) for r in want.select("k", "ano", "mes", "v").collect())


def test_replace_periods_leaves_other_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    before = spark.createDataFrame([(1, 2024, 1, 1), (2, 2024, 2, 2)], ROW)
    writers.append(before, path, ["ano", "mes"])
    after = spark.createDataFrame([(5, 2024, 2, 5), (6, 2024, 2, 6)], ROW)
    writers.replace_periods(after, path)
    assert table(spark, path) == [(1, 2024, 1, 1), (5, 2024, 2, 5), (6, 2024, 2, 6)]
    diff = writers.compare_periods(before, spark.read.parquet(path))
    assert sorted(map(tuple, diff.collect())) == [(2024, 1, 1, 1, 0), (2024, 2, 1, 2, 1)]


def test_periods(spark):
    assert periods.current_and_previous(date(2025, 1, 15)) == [(2025, 1), (2024, 12)]
    assert periods.work_list(date(2025, 2, 1)) == [(2025, 2)]
    assert periods.work_list(date(2025, 2, 1), full=True, first=2024)[-1] == (2025, 2)
    assert len(periods.work_list(date(2025, 2, 1), full=True, first=2024)) == 14
    have = spark.createDataFrame([(2024, 1)], "ano int, mes int")
    todo = periods.missing_periods(spark, [(2024, 1), (2024, 2)], have)
    assert [tuple(r) for r in todo.collect()] == [(2024, 2)]
    source = spark.createDataFrame([(2023,), (2024,), (2025,)], "ano int")
    assert periods.since_last(source, have).count() == 2
    assert periods.since_last(source, have.limit(0)).count() == 3
    months = spark.createDataFrame([(2024, 1), (2024, 2)], "ano int, mes int")
    assert periods.in_periods(months, [(2024, 2)]).count() == 1


def test_json_documents(spark, tmp_path):
    folder = tmp_path / "deputado=74"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"dados": [{"codDocumento": "1", "valor": 2.5}, {"codDocumento": "x", "valor": None}]}))
    schema = T.StructType.fromDDL("dados array<struct<codDocumento: string, valor: double>>")
    docs = readers.read_json_documents(spark, str(tmp_path), schema)
    from ledgerlens.functions.keys import number_after

    got = docs.select(number_after("arquivo", "deputado=").alias("d"), F.col("codDocumento").try_cast("bigint").alias("c"))
    assert sorted(map(tuple, got.collect()), key=repr) == [(74, 1), (74, None)]


def test_seed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "terms.csv"
    path.write_text('"idLegislatura";"uri";"dataInicio";"dataFim";"anoEleicao"\n"57";"u";"2023-02-01";"2027-01-31";"2022"\n', encoding="utf-8-sig")
    row = readers.read_seed(spark, str(path), "legislaturas").first()
    assert (row.idLegislatura, row.dataInicio, row.anoEleicao) == (57, date(2023, 2, 1), 2022)


@pytest.mark.parametrize("mode, n", [("drop", 1), ("keep", 2)])
def test_malformed_lines(spark, tmp_path, mode, n):
    path = tmp_path / "x.csv"
    path.write_text("a;b\n1;2\nbad;3;4\n")
    got = readers.read_delimited(spark, str(path), T.StructType.fromDDL("a int, b int"), bad_rows=mode).collect()
    assert len(got) == n
    if mode == "keep":
        assert [r._corrupt_record for r in got] == [None, "bad;3;4"]


def test_projection_of_nested_profile(spark):
    schema = """id string, cpf string, nomeCivil string, dataNascimento string, municipioNascimento string,
        ufNascimento string, sexo string, redeSocial array<string>, uri string,
        ultimoStatus struct<data: string, nome: string, nomeEleitoral: string, siglaPartido: string, siglaUf: string,
          idLegislatura: int, condicaoEleitoral: string, situacao: string, urlFoto: string,
          gabinete: struct<email: string, telefone: string, nome: string>>"""
    status = ("2024-13-01", "N", "E", "PT", "SP", 57, "Titular", "Exercício", "f", ("e@x", "t", "g"))
    df = spark.createDataFrame([("7", "c", "n", "1970-02-03", "m", "SP", "M", ["a", "b"], "u", status)], schema)
    row = readers.project(df, schemas.projection("deputados_detalhes")).first()
    assert (row.id, row.data_nascimento, row.redes_sociais) == (7, date(1970, 2, 3), "a, b")
    assert (row.ultimo_status_data, row.ultimo_status_email_gabinete) == (None, "e@x")


def test_boolean_from_number_and_align(spark):
    df = spark.createDataFrame([("1",), ("0",), (None,)], "p string")
    got = [r.p for r in readers.project(df, {"p": ("p", "boolean")}).collect()]
    assert got == [True, False, False]
    wide = spark.createDataFrame([(1, "x", 2.0)], "DEPUTADO_ID int, Sobra string, valor double")
    aligned = readers.align(wide, T.StructType.fromDDL("deputado_id bigint, parcela bigint, valor double"))
    assert [tuple(r) for r in aligned.collect()] == [(1, None, 2.0)]


def test_flatten_and_land_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, ("x", (2,)))], "a int, s struct<b: string, c: struct<d: int>>")
    assert readers.flatten(df).columns == ["a", "s_b", "s_c_d"]
    (tmp_path / "v.csv").write_text("id;autor.nome\n1;x\n1;x\n2;y\n")
    landed = writers.land_csv(spark, str(tmp_path / "v.csv"), str(tmp_path / "out"), T.StructType([T.StructField("id", T.IntegerType()), T.StructField("autor.nome", T.StringType())]))
    assert landed.columns == ["id", "autor_nome"] and landed.count() == 2
    writers.export_csv(landed, str(tmp_path / "csv"), [F.col("id")])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    audit = writers.rows_per_file(spark.read.parquet(str(tmp_path / "out")))
    assert sum(r.linhas for r in audit.collect()) == 2


def test_every_schema_matches_its_projection():
    for name in schemas.TABLES:
        assert [f.name for f in schemas.schema(name).fields] == list(schemas.projection(name))
        assert set(schemas.keys(name)) <= set(schemas.projection(name))


def test_unique_stream_keeps_late_rows(spark, tmp_path):
    """A row two years late whose key is new stays; repeats go, in a batch and across batches."""
    schema = "k int, dia string, v int"
    folder, path = str(tmp_path / "in"), str(tmp_path / "t")
    batches = [[(1, "2024-05-01", 1), (1, "2024-05-01", 1)], [(1, "2024-05-01", 2), (2, "2022-01-01", 3)], [(None, "2024-05-01", 4)]]
    for rows in [*batches, batches[2]]:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = streams.arriving_files(spark, folder, T._parse_datatype_string(schema), files_per_batch=1)
        streams.append_unique(stream, path, str(tmp_path / "offsets"), ["k", "dia"], ["dia"]).awaitTermination()
    got = spark.read.schema(schema).parquet(path).select("k", "dia", "v").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "2024-05-01", 1), (2, "2022-01-01", 3), (None, "2024-05-01", 4)]


def test_reload_empties_a_month_without_rows(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    old = [(1, 2019, 12), (2, 2020, 1), (3, 2020, 2)]
    df = lambda x: spark.createDataFrame(x, "k bigint, ano int, mes int")
    writers.overwrite(df(old), path, ["ano", "mes"])
    writers.reload_periods(df([(4, 2020, 1), (5, 2020, 2)]), path, [(2019, 12), (2020, 1)])
    back = spark.read.schema("k bigint, ano int, mes int").parquet(path)
    assert rows(back, "k", "ano", "mes") == [(3, 2020, 2), (4, 2020, 1)]


def test_landings_stand_side_by_side(spark, tmp_path):
    df = spark.createDataFrame([(i, 2020, i % 2) for i in range(20)], "k bigint, ano int, mes int").repartition(5)
    for stamp in ("a", "b", "b"):
        writers.land_period_files(df, str(tmp_path), "x", stamp)
    files = sorted(str(p.relative_to(tmp_path).parent) for p in tmp_path.rglob("*.parquet"))
    assert files == [f"x-{s}/ano=2020/mes={m}" for s in "ab" for m in (0, 1)]


def test_listing_rows_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "l")
    df = spark.range(5000).selectExpr("cast(id as int) as k", "repeat('x', 20) as pad").repartition(4)
    writers.export_csv(df, path, [F.col("k").desc()], ";")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")  # files are split, and splits packed
    try:
        read = readers.listing_rows(readers.read_delimited(spark, path, df.schema))
        assert read.where("linha <> 5000 - k").count() == 0 and read.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_timed_batches_and_empty_ones(spark, tmp_path):
    import time

    base = str(tmp_path)
    schema = "k bigint, ano int, mes int"
    put = lambda x: spark.createDataFrame(x, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    put([(1, 2020, 1)])
    stream = streams.arriving_files(spark, f"{base}/in", spark.createDataFrame([], schema).schema)
    run = streams.merge_stream(stream, f"{base}/t", f"{base}/o", ["k"], every="1 second")
    try:
        run.processAllAvailable()
        time.sleep(3)  # triggers without new files write nothing
        stamp = sorted(p.name for p in (tmp_path / "t").rglob("*.parquet"))
        put([(2, 2020, 1), (1, 2020, 2)])
        run.processAllAvailable()
    finally:
        run.stop()
    assert len(stamp) == 1
    got = spark.read.schema(schema).parquet(f"{base}/t").collect()
    assert sorted(map(tuple, got)) == [(1, 2020, 2), (2, 2020, 1)]
