import pytest
from pyspark.sql import types as T

from tamizal import __main__ as runner
from tamizal.sources import files

HEADERS = {"releases": ["ocid", "tag"], "tender": ["ocid", "title"]}


def test_month(spark, tmp_path):
    for name, text in {"releases_2024_01.csv": "ocid,tag\na,1\na,2\nb,3\n", "tender_2024_01.csv": "ocid,title\na,x\n", "metadata_1.csv": "k\n"}.items():
        (tmp_path / name).write_text(text)
    tables, said = files.normalise_month(spark, str(tmp_path), HEADERS, ["metadata"])
    assert sorted((r["ocid"], r["tag"]) for r in tables["releases"].collect()) == [("a", "1"), ("b", "3")]
    assert said == ["1 releases repeat an ocid"] and tables["tender"].count() == 1
    with pytest.raises(files.ContractError):
        files.normalise_month(spark, str(tmp_path), HEADERS, ["extensions"])
    (tmp_path / "tender_2024_01.csv").write_text("ocid,name\na,x\n")
    with pytest.raises(files.ContractError):
        files.normalise_month(spark, str(tmp_path), HEADERS)


def test_methods(spark, tmp_path):
    schema = T.StructType([T.StructField("ocid", T.StringType())])
    (tmp_path / "a.json").write_text('{"ocid": "x"}')
    (tmp_path / "b.json").write_text("")
    d, state = files.read_methods(spark, str(tmp_path), ["a", "b", "c"], schema)
    assert state == {"a": "ok", "b": "sin_datos", "c": "fallo"} and d.count() == 1
    assert files.read_methods(spark, str(tmp_path), ["b", "c"], schema)[0].count() == 0
    with pytest.raises(files.ContractError):
        files.read_methods(spark, str(tmp_path), ["c", "d"], schema)


def test_window_gates(spark):
    d = lambda rows: spark.createDataFrame(rows, "anio int, mes int")
    items = d([(2024, 1), (2024, 2), (2024, 3)])
    assert files.gated_window(items, items, 4).count() == 3
    for processes, months in ((items, 5), (d([(2024, 1), (2024, 2)]), 4)):
        with pytest.raises(files.ContractError):
            files.gated_window(items, processes, months)


def test_year(spark, tmp_path):
    save = lambda name, rows, kind: spark.createDataFrame(rows, kind).write.partitionBy("anio", "mes").parquet(str(tmp_path / name))
    save("procesos", [("a", 2024, 1, 1, "m1", "b1"), ("a", 2024, 5, 1, "m2", "b2"), ("a", 2025, 1, 1, "m3", "b3"), (None, 2024, 1, 2, "m", "b")], "ocid string, anio int, mes int, orden int, metodo string, comprador_ruc string")
    save("items", [("a", 2024, 1, "award", "1", 1.0, "u", 2.0)], "ocid string, anio int, mes int, origen string, cpc string, cantidad double, unidad string, precio_unitario double")
    save("oferentes", [("a", 2024, 1, "r", True), ("a", 2024, 2, "r", True), ("a", 2024, 1, "s", False), ("a", 2024, 1, None, True)], "ocid string, anio int, mes int, ruc string, gano boolean")
    y = files.read_year(spark, str(tmp_path), 2024)
    assert [tuple(r) for r in y["procesos"].collect()] == [("a", "m2", "b2")]
    assert [tuple(r) for r in y["ganadores"].collect()] == [("a", "r")] and y["items"].count() == 1


def test_refresh_and_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.range(3), path)
    files.replace_table(spark.read.parquet(path).where("id > 0"), path)  # made of itself
    assert spark.read.parquet(path).count() == 2
    stored = files.refresh(spark, str(tmp_path), {"one": lambda: spark.range(5), "two": lambda: spark.read.parquet(str(tmp_path / "one")).where("id > 2")})
    assert (stored["one"].count(), stored["two"].count()) == (5, 2)
    kind = "k string, t int, v string"
    base, part = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], kind), spark.createDataFrame([("a", 2, "n"), ("b", 4, "old"), ("c", 1, None)], kind)
    once = files.upsert(base, part, ["k"], "t")
    assert sorted(map(tuple, once.collect())) == [("a", 2, "n"), ("b", 5, "y"), ("c", 1, None)] == sorted(map(tuple, files.upsert(once, part, ["k"], "t").collect()))


TREE = [("1", 1, "uno", ""), ("12", 2, "dos", "1"), ("123", 3, "tres", "12"), ("1234", 4, "cuatro", "123"), ("12345", 5, "", "1234")]


def tree(tmp_path, rows):
    (tmp_path / "t.csv").write_text("\ufeffCodigo,Nivel,Descripcion,Codigo_Padre\n" + "".join(f"{a},{b},{c},{d}\n" for a, b, c, d in rows), encoding="utf-8")
    return str(tmp_path / "t.csv")


def test_tree(spark, tmp_path):
    got = files.read_tree(spark, tree(tmp_path, TREE), levels=dict.fromkeys(range(1, 6), 1))
    assert sorted(map(tuple, got.collect()))[-1] == ("12345", 5, "cuatro", "1234")
    bad = [TREE[:-1] + [("12345", 4, "x", "1234")], TREE[:1] + TREE[2:], [*TREE, TREE[0]], [("2", 1, "x", "")], [*TREE, ("12346", 5, "seis", "1235")]]
    for rows in bad:
        with pytest.raises(files.ContractError):
            files.read_tree(spark, tree(tmp_path, rows))
    with pytest.raises(files.ContractError):
        files.read_tree(spark, tree(tmp_path, TREE), most_inherited=0)
    with pytest.raises(files.ContractError):
        files.read_tree(spark, tree(tmp_path, TREE), levels={1: 2})


def test_products(spark, tmp_path):
    nodes = spark.createDataFrame([("12345", 5), ("1234", 4)], "codigo string, nivel int")
    (tmp_path / "p.csv").write_bytes("c;n;u\n123450001;Año;40,00%\n123450001;otra;1,00%\n;x;y\n123450002;B;\n".encode("latin-1"))
    assert sorted(map(tuple, files.read_products(spark, str(tmp_path / "p.csv"), nodes).collect())) == [("123450001", "Año", 0.4, "12345"), ("123450002", "B", None, "12345")]
    with pytest.raises(files.ContractError):
        files.read_products(spark, str(tmp_path / "p.csv"), nodes, least=3)
    with pytest.raises(files.ContractError):
        files.read_products(spark, str(tmp_path / "p.csv"), nodes.where("nivel = 4"))


def test_runner(spark, data, tmp_path, capfd):
    runner.run(spark, ["sel05_settled", data, "--desde", "202401", "--hasta", "202402", "--salida", str(tmp_path / "o")])
    assert {(r["anio"], r["mes"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {(2024, 1), (2024, 2)}
    runner.run(spark, ["sel05_settled", data, "--seco"])
    with pytest.raises(SystemExit):
        runner.run(spark, ["no_such_query", data])
