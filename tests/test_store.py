"""Tables that change while others read them, and jobs that are lost half way."""

import random

import pytest
from pyspark.sql import functions as F

from botiquin.contracts import ITEM_KEY, SCHEMAS
from botiquin.operators.dedupe import latest_items
from botiquin.plans import loads
from botiquin.sources import store as stores
from botiquin.sources.store import TableStore, bucket_column

EDIT = "id long, v string, actualizado_en int"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def files(store, table):
    """Names of a table's files by partition folder."""
    found = store._found(store.path(table).removeprefix(f"{store._base()}/") + "/*/*.parquet")
    out = {}
    for path in found:
        out.setdefault(path.rsplit("/", 2)[1], set()).add(path.rsplit("/", 1)[1])
    return out


def rows(store, table):
    return sorted(map(str, (tuple(r) for r in store.read(table).collect())))


def test_merge_leaves_other_buckets_alone(spark, store):
    base = spark.range(200).select("id", F.lit("a").alias("v"), F.lit(1).alias("actualizado_en"))
    store.refresh("t", base.limit(0), allow_empty=True)
    assert store.merge("t", base, ["id"], buckets=16) == 200
    before = files(store, "t")
    assert all(name.startswith(bucket_column(["id"], 16)) for name in before)
    one = spark.createDataFrame([(7, "b", 2)], EDIT)
    assert store.merge("t", one, ["id"], buckets=16) == 200
    after = files(store, "t")
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()
    once = rows(store, "t")
    assert [r.id for r in store.read("t").where("v = 'b'").collect()] == [7]
    assert store.merge("t", one, ["id"], buckets=16) == 200 and rows(store, "t") == once
    assert store.merge("t", one.limit(0), ["id"], buckets=16) == 200 and rows(store, "t") == once
    assert len(store._loads("t")) == 2                    # the refresh and the layout, no more


def test_merge_by_other_keys_and_null_keys(spark, store):
    store.refresh("t", spark.createDataFrame([(1, "a", 1), (2, "b", 1)], EDIT))
    null = spark.createDataFrame([(None, "n", 3)], EDIT)
    assert store.merge("t", null, ["id"], buckets=4) == store.merge("t", null, ["id"], buckets=4) == 3
    assert store.merge("t", spark.createDataFrame([(9, "a", 2)], EDIT), ["v"], buckets=4) == 3
    assert rows(store, "t") == ["(2, 'b', 1)", "(9, 'a', 2)", "(None, 'n', 3)"] or len(rows(store, "t")) == 3
    with pytest.raises(ValueError, match="underscores"):
        store.merge("t", null, ["a__b"])


def test_appends_to_a_merged_table(spark, store):
    store.refresh("t", spark.createDataFrame([(1, "a", 1)], EDIT))
    store.merge("t", spark.createDataFrame([(2, "b", 1)], EDIT), ["id"], buckets=4)
    store.append("t", spark.createDataFrame([(3, "c")], "id int, v string"))
    assert rows(store, "t") == ["(1, 'a', 1)", "(2, 'b', 1)", "(3, 'c', None)"]
    assert store.merge("t", spark.createDataFrame([(3, "d", 5)], EDIT), ["id"], buckets=4) == 3
    assert rows(store, "t")[2] == "(3, 'd', 5)"


def test_a_lost_replacement_is_finished_by_the_next_reader(spark, store, monkeypatch):
    base = spark.range(40).select("id", F.lit("a").alias("v"), F.lit(1).alias("actualizado_en"))
    store.refresh("t", base.limit(0), allow_empty=True)
    store.merge("t", base, ["id"], buckets=4)
    edit = spark.createDataFrame([(n, "b", 2) for n in range(40)], EDIT)

    def lost(self, folder):
        if self._exists(f"{self._waiting(folder)}/_SUCCESS"):
            raise RuntimeError("lost")

    monkeypatch.setattr(TableStore, "_finish", lost)
    with pytest.raises(RuntimeError, match="lost"):
        store.merge("t", edit, ["id"], buckets=4)
    # Spark had already removed a bucket when the driver went.
    store._fs.delete(store._path(store._found(
        store.path("t").removeprefix(f"{store._base()}/") + "/_cubo*")[0]), True)
    monkeypatch.undo()
    assert store.read("t").where("v = 'b'").count() == store.count("t") == 40
    # What was not complete does not count.
    edit.limit(1).write.parquet(f"{store._waiting(store.path('t'))}/half")
    assert store.count("t") == 40


def test_appends_and_old_loads(spark, store):
    store.refresh("t", spark.range(3))
    store.append("t", spark.range(3, 5))
    store.append("t", spark.range(5, 6))
    store.append("t", spark.range(0))
    assert sorted(r.id for r in store.read("t").collect()) == list(range(6))
    assert len(files(store, "t")) == 3                    # a folder per batch
    # What a lost append leaves behind is a folder that Spark does not read.
    spark.range(100).write.parquet(f"{store.path('t')}/.spark-staging-lost/_lote=9")
    assert store.count("t") == 6
    store.refresh("t", spark.range(2))
    store.refresh("t", spark.range(1))
    assert store.clean("t", keep=1) and store.count("t") == 1
    assert len(store._loads("t", complete=False)) == 1


def test_tables_of_a_load_switch_together(spark, store):
    load = store.load("t")
    load.write("t", spark.range(3))
    load.write("t_apartados", spark.range(5))
    assert not store.exists("t") and not store.exists("t_apartados")
    load.commit()
    assert (store.count("t"), store.count("t_apartados")) == (3, 5)
    lost = store.load("t")
    lost.write("t", spark.range(30))
    assert (store.count("t"), store.count("t_apartados")) == (3, 5)
    # A load without rejects leaves none of the last one's.
    assert store.refresh("t", spark.range(4)) == 4
    assert store.count("t") == 4 and not store.exists("t_apartados")


def test_layout_by_key_keeps_the_tables_beside(spark, store):
    load = store.load("t")
    load.write("t", spark.createDataFrame([(1, "a", 1)], EDIT))
    load.write("t_apartados", spark.range(5))
    load.commit()
    store.merge("t", spark.createDataFrame([(2, "b", 1)], EDIT), ["id"], buckets=4)
    assert (store.count("t"), store.count("t_apartados")) == (2, 5)


HEAD = "Id. Llamado,Licitación,Codigo,Item,Cantidad Máxima\n"


def load(spark, store, folder, lines):
    folder.mkdir(exist_ok=True)
    (folder / "ejecucion.csv").write_text(HEAD + lines)
    return loads.load_folder(spark, str(folder), store, ["ejecucion"])[0]


@pytest.mark.parametrize("lost_at", ["ejecucion_apartados", "ejecucion_sobrantes", None])
def test_a_failing_load_leaves_the_whole_old_one(spark, store, tmp_path, monkeypatch, lost_at):
    assert load(spark, store, tmp_path / "in", "1,L,A,1,5\nx,L,B,1,5\n3,L,D,1,5,9\n").status == "OK"
    tables = ("ejecucion", "ejecucion_apartados", "ejecucion_sobrantes")
    before = [rows(store, t) for t in tables]
    write, commit = stores.Load.write, stores.Load.commit

    def failing(self, table, *args, **kwargs):
        if table == lost_at:
            raise RuntimeError("lost")
        return write(self, table, *args, **kwargs)

    def no_commit(self):
        if lost_at is None:
            raise RuntimeError("lost")
        commit(self)

    monkeypatch.setattr(stores.Load, "write", failing)
    monkeypatch.setattr(stores.Load, "commit", no_commit)
    assert load(spark, store, tmp_path / "in", "2,L,C,1,6\n").status == "ERROR: lost"
    monkeypatch.undo()
    assert [rows(store, t) for t in tables] == before
    # All rows rejected: nothing changes either.
    assert load(spark, store, tmp_path / "in", "y,L,C,1,6\n").status == "VACIO"
    assert [rows(store, t) for t in tables] == before
    assert load(spark, store, tmp_path / "in", "2,L,C,1,6\n").status == "OK"
    assert [store.count(t) for t in tables] == [1, 0, 0]


def test_figures_of_a_load_come_from_its_one_write(spark, store, tmp_path):
    got = load(spark, store, tmp_path / "in",
               "1,L,A,1,5\n1.5,,B,dos,100000000000000000\n,L,C,1,6\nx,L,D,1,100000000000000000\n")
    assert (got.rows, got.set_aside, got.misfits) == (3, 1, 0)    # numbers are read as the table's
    assert set(got.findings) == {
        "ejecucion: 1 valores no numéricos en id_llamado", "ejecucion: 1 valores no numéricos en item",
        "ejecucion: 1 valores nulos en id_llamado", "ejecucion: 1 valores nulos en licitacion"}


def test_the_newest_batch_wins_however_rows_are_dealt(spark, store, tmp_path):
    assert load(spark, store, tmp_path / "in", "1,L,A,1,6\n2,L,B,1,7\n3,L,C,1,8\n").rows == 3
    schema = SCHEMAS["ejecucion"]

    def batch(quantity):
        names = [*ITEM_KEY, "cantidad_maxima"]
        lines = spark.createDataFrame([(1, "L", "A", "1", quantity), (2, "L", "B", "1", quantity)], names)
        return stores.stamp_defaults(stores.fit_to(lines, schema)[0], schema)

    for quantity in (50, 99):
        store.append("ejecucion", batch(quantity))
    table = store.read("ejecucion")
    assert table.count() == 7
    draw = random.Random(1)
    for _ in range(20):
        dealt = table.repartition(draw.randint(1, 9)).orderBy(F.rand(draw.randint(0, 999)))
        got = latest_items(dealt)
        assert sorted((r.id_llamado, int(r.cantidad_maxima)) for r in got.collect()) == [(1, 99), (2, 99), (3, 8)]


def test_rows_of_a_load_know_their_place(spark, store, tmp_path):
    load(spark, store, tmp_path / "in", "".join(f"{n},L,A,1,{n}\n" for n in range(1, 200)))
    got = store.read("ejecucion").orderBy("orden_carga").collect()
    assert [r.id_llamado for r in got] == list(range(1, 200))
    assert {r.orden_carga.carga for r in got} == {1}
    assert got[0].orden_carga.archivo.endswith("ejecucion.csv")
