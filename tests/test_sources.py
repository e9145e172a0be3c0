"""Sources and sinks round trip."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricewright.operators import reshape
from pricewright.operators.filters import horizon
from pricewright.session import ensure_checkpoint_dir
from pricewright.sources import readers, writers
from pricewright.streaming import landing
from pricewright.streaming.landing import land_once


def test_delimited_with_encoding(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("Município;Filial SUGESTÃO;UF\nSão Paulo;Filial Sul;SP\n".encode("ISO-8859-1"))
    names = ["Município", "Filial SUGESTÃO", "UF"]
    assert rows(readers.read_delimited(spark, str(path), readers.all_text(names))) == [("São Paulo", "Filial Sul", "SP")]


def test_typed_result_file(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('a,b\n1,"x, ""y"""\n,z\n')
    assert rows(readers.read_result(spark, str(path), "a int, b string")) == [(1, 'x, "y"'), (None, "z")]


def test_csv_export_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([("ação", 1.5), (None, 2.0)], "t string, v double")
    writers.write_csv(df, str(tmp_path / "out"))
    assert rows(readers.read_delimited(spark, str(tmp_path / "out"), "t string, v double", encoding="UTF-8"), "v") == [("ação", 1.5), (None, 2.0)]
    writers.write_review_sheet(df, str(tmp_path / "sheet"))
    assert rows(readers.read_review_sheet(spark, str(tmp_path / "sheet"), "t string, v double"), "v")[0] == ("ação", 1.5)


def test_extracts_without_landing_partitions(spark, tmp_path):
    spark.range(3).withColumn("year", F.lit(2020)).write.partitionBy("year").parquet(str(tmp_path / "landing"))
    spark.range(3, 5).write.parquet(str(tmp_path / "extra"))
    frames = readers.read_extracts(spark, str(tmp_path / "landing"), [str(tmp_path / "extra")])
    assert [f.columns for f in frames] == [["id"], ["id"]] and sum(f.count() for f in frames) == 5


def test_json_and_xml_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"id": 1, "uf": {"sigla": "SP"}}\n{"id": 2, "uf": null}\n')
    (tmp_path / "doc.json").write_text('[{"id": 1,\n "uf": {"sigla": "SP"}},\n {"id": 2, "uf": null}]')
    whole = readers.read_json_records(spark, str(tmp_path / "doc.json"), "id bigint, uf struct<sigla: string>", {"id": "ID"}, multi_line=True)
    assert rows(whole, "ID") == [(1,), (2,)]
    got = readers.read_json_records(spark, str(tmp_path / "c.json"), "id bigint, uf struct<sigla: string>", {"id": "ID", "uf.sigla": "UF"})
    assert rows(got, "ID") == [(1, "SP"), (2, None)]
    (tmp_path / "s.xml").write_text("<Envelope><Body><Survey><a>1</a><b>x</b></Survey><Survey><a>2</a></Survey></Body></Envelope>")
    got = readers.read_xml_records(spark, str(tmp_path / "s.xml"), "Survey", "a int, b string", {"a": "A", "b": "B"})
    assert rows(got, "A") == [(1, "x"), (2, None)]


def test_append_only_with_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.append_batch(spark.range(2), path, "a") and not writers.append_batch(spark.range(0), path, "b")
    assert writers.append_batch(spark.range(2, 3), path, "c") and spark.read.parquet(path).count() == 3
    assert writers.append_batch(spark.range(2), path, "a") and spark.read.parquet(path).count() == 3  # a repeated run


def test_partitioned_and_compacted_tables(spark, tmp_path):
    df = spark.range(100).withColumn("p", F.col("id") % 2)
    writers.write_table(df, str(tmp_path / "t"), ["p"])
    writers.write_table(df, str(tmp_path / "t"), ["p"])
    pruned = readers.read_table(spark, str(tmp_path / "t"), ["id", "p"]).where("p = 1")
    assert pruned.count() == 50 and "PartitionFilters: [isnotnull(p" in pruned._jdf.queryExecution().executedPlan().toString()
    writers.write_compacted(df.repartition(20), str(tmp_path / "c"))
    assert len(list((tmp_path / "c").glob("*.parquet"))) < 20 and spark.read.parquet(str(tmp_path / "c")).count() == 100


def test_overwrite_own_input(spark, tmp_path):
    path = str(tmp_path / "own")
    first = writers.write_version(spark.range(3), path)
    for n in (5, 7, 9):
        writers.write_version(writers.read_version(spark, path).unionByName(spark.range(n - 2, n)), path)
        assert writers.read_version(spark, path).count() == n
    kept = writers.versions(spark, path)
    assert len(kept) == 2 and not any(first in f for f in kept)
    (tmp_path / "own" / "version=999999999999999-torn").mkdir()  # a job that died while writing
    assert writers.read_version(spark, path).count() == 9 and writers.versions(spark, str(tmp_path / "none")) == []
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_export_files_are_landed_once(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()

    def land():
        land_once(spark, str(source), "a int", str(target), str(state)).awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(str(target)).collect())

    (source / "one.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert land() == [1, 2] and land() == [1, 2]
    (source / "two.json").write_text('{"a": 3}\n')
    assert land() == [1, 2, 3]


# --- tables kept by partition -------------------------------------------------------------------------

def _files(path):
    """Name and time of every data file by its folder."""
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet") if "_pending" not in str(f)}


def test_replaced_partitions_leave_the_others_alone(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(30).withColumn("d", F.expr("date_add(DATE'2020-01-01', int(id % 5))"))
    writers.write_table(df, str(path), ["d"])
    before, day = _files(path), [F.expr(f"DATE'2020-01-0{n}'") for n in range(1, 6)]
    own = spark.read.parquet(str(path))
    new = own.where((F.col("d") == day[1]) & (F.col("id") > 10)).withColumn("id", F.col("id") * 100)
    writers.replace_partitions(new, str(path), "d", ["2020-01-02", "2020-01-03"])
    after = _files(path)
    assert {f: t for f, t in before.items() if "-02/" not in f and "-03/" not in f} == {f: t for f, t in after.items() if "-02/" not in f}
    got = spark.read.parquet(str(path))
    assert rows(got.where(F.col("d") == day[1]).select("id"), "id") == [(1100,), (1600,), (2100,), (2600,)]
    assert got.where(F.col("d") == day[2]).count() == 0 and got.count() == 18 + 4


def test_replacement_that_dies(spark, tmp_path, monkeypatch):
    """Before its rows are complete nothing has happened; afterwards the next run finishes it."""
    path = str(tmp_path / "t")
    writers.write_table(spark.range(6).withColumn("p", F.col("id") % 3), path, ["p"])
    old = rows(spark.read.parquet(path), "id")
    broken = spark.read.parquet(path).where("p = 1").withColumn("id", F.expr("if(id > 2, raise_error('lost'), id)").cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        writers.replace_partitions(broken, path, "p", [1])
    assert rows(spark.read.parquet(path), "id") == old and not writers.settle_partitions(spark, path, "p")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(writers, "settle_partitions", die)
        with pytest.raises(RuntimeError):
            writers.replace_partitions(spark.read.parquet(path).where("p = 1").withColumn("id", F.col("id") + 100), path, "p", [1, 2])
    assert rows(spark.read.parquet(path), "id") == old
    assert writers.settle_partitions(spark, path, "p") and not writers.settle_partitions(spark, path, "p")
    assert sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == [0, 3, 101, 104]


def _exports(folder, name, items):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(dict(zip(("day", "k", "v"), i))) for i in items))


def _monthly(landed):
    return landed.groupBy("period", "k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))


def _land(spark, tmp_path, source, checkpoint="cp", **more):
    landing.land_and_refresh(
        spark, str(source), "day date, k string, v bigint", str(tmp_path / "batches"), str(tmp_path / "mart"), str(tmp_path / checkpoint),
        F.trunc("day", "month"), _monthly, options={"maxFilesPerTrigger": "1"}, **more,
    ).awaitTermination()
    return sorted((str(r.period), r.k, r.v, r.n) for r in spark.read.parquet(str(tmp_path / "mart")).collect())


def test_incremental_mart_equals_a_full_run(spark, tmp_path):
    source, whole = tmp_path / "in", {}
    parts = {
        "a": [("2020-01-05", "x", 1), ("2020-02-01", "x", 2)],
        "b": [("2020-02-20", "y", 4), ("2020-02-21", "x", 8)],
        "late": [("2020-01-31", "x", 16)],
        "c": [("2020-03-01", "z", 32)],
    }
    for name, items in parts.items():
        if name == "c":  # the file of January's late row has come; February's files must stay as they are
            february = {f: t for f, t in _files(tmp_path / "mart").items() if "2020-02" in f}
        _exports(source, name, items)
        got = _land(spark, tmp_path, source)
        for day, k, v in items:
            key = (f"{day[:7]}-01", k)
            whole[key] = [a + b for a, b in zip(whole.get(key, [0, 0]), (v, 1))]
        assert got == sorted((*k, *v) for k, v in whole.items()), name
    assert {f: t for f, t in _files(tmp_path / "mart").items() if "2020-02" in f} == february
    # A batch that is delivered again, here with all files after a lost checkpoint, replaces itself.
    again = _land(spark, tmp_path, source, "cp2")
    assert again == sorted((*k, *v) for k, v in whole.items())


def test_frozen_periods_keep_their_mart(spark, tmp_path):
    from pricewright.operators.forecast import freeze_history

    source = tmp_path / "in"
    _exports(source, "a", [("2020-01-05", "x", 1), ("2020-02-01", "x", 2)])
    _land(spark, tmp_path, source)
    history = spark.createDataFrame(spark.read.parquet(str(tmp_path / "mart")).collect(), "k string, v bigint, n bigint, period date")
    _exports(source, "b", [("2020-01-07", "x", 100), ("2020-02-02", "x", 4)])
    got = _land(spark, tmp_path, source, open_from="2020-02-01")
    current = _monthly(spark.read.parquet(str(tmp_path / "batches")))
    want = freeze_history(history, current, "period", F.lit("2020-02-01").cast("date"))
    assert got == sorted((str(r.period), r.k, r.v, r.n) for r in want.collect()) == [("2020-01-01", "x", 1, 1), ("2020-02-01", "x", 6, 2)]
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 4


def test_ledger_by_day(spark, tmp_path):
    """Only changed days are written; a rerun, and a run after a lost one, give what the whole merge gives."""
    from pricewright.operators.ledger import ledger_merge
    from pricewright.plans.audit import merge_day

    path, n = tmp_path / "ledger", F.col("id")
    old = spark.range(200).select(
        n, F.expr("date_add(DATE'2020-03-01', int(id % 20))").alias("date"), n.cast("double").alias("price"),
        # All rows of older days are decided but for one of the 2nd.
        F.when((n != 41) & (n % 20 <= 12), F.lit("Sim")).alias("approved_manually"),
        F.lit("Não").alias("approved_automatically"),
    )
    writers.write_table(old, str(path), ["date"])
    batch = spark.createDataFrame([(1000, 1.0), (1001, 2.0)], "id bigint, price double").withColumn("date", F.lit("2020-03-21").cast("date"))
    reviews = spark.createDataFrame([(15, "Sim", 1), (15, "Não", 2), (41, "Sim", 1), (9999, "Sim", 1)], "id bigint, verdict string, reviewed_at int")
    want = ledger_merge(old, batch, reviews, "2020-03-21")
    listed = lambda df: sorted(map(str, df.select("id", "date", "price", "approved_manually", "approved_automatically").collect()))
    want, before = listed(want), _files(path)
    touched = merge_day(spark, str(path), batch, reviews, "2020-03-21")
    # The row of the 2nd that nobody reviewed in time, the review of the 16th, the day itself.
    assert [str(d) for d in touched] == ["2020-03-02", "2020-03-16", "2020-03-21"]
    assert listed(spark.read.parquet(str(path))) == want
    kept = {f: t for f, t in before.items() if not any(f"date={d}/" in f for d in touched)}
    assert kept and kept.items() <= _files(path).items()
    merge_day(spark, str(path), batch, reviews, "2020-03-21", since="2020-03-14")
    assert listed(spark.read.parquet(str(path))) == want and kept.items() <= _files(path).items()


# --- damaged records -------------------------------------------------------------------------------------

def test_every_json_line_is_valid_or_rejected(spark, tmp_path):
    lines = [
        '{"id": 1, "uf": {"sigla": "SP"}}', '{"id": 2, "uf": null}', '{"id": 3, "uf": {"sigla": "RJ"', "no record", "", "   ", "[1, 2]",
        '{"id": "four", "uf": {"sigla": "MG"}}', '{"other": 5}', '{"id": 6} trailing', "null",
    ]
    (tmp_path / "c.json").write_text("\n".join(lines) + "\n")
    valid, rejected = readers.split_json_records(
        spark, str(tmp_path / "c.json"), "id bigint, uf struct<sigla: string>", {"id": "ID", "uf.sigla": "UF"}
    )
    assert {tuple(r) for r in valid.collect()} == {(1, "SP"), (2, None), (None, None)}
    bad = sorted(r[0] for r in rejected.collect())
    assert valid.count() + len(bad) == len(lines)
    assert set(lines[2:8]) <= set(bad)


def test_every_csv_line_is_valid_or_rejected(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("nome;n;uf\nSão Paulo;1;SP\nRio;x;RJ\nNatal;3\nBelém;4;PA;extra\n;;\n".encode("ISO-8859-1"))
    schema = readers.all_text(["nome"]).add("n", "integer").add("uf", "string")
    valid, rejected = readers.split_delimited(spark, str(path), schema)
    assert sorted(map(tuple, valid.collect()), key=str) == sorted([("São Paulo", 1, "SP"), (None, None, None)], key=str)
    assert sorted(r.raw_line for r in rejected.collect()) == ["Belém;4;PA;extra", "Natal;3", "Rio;x;RJ"]
    assert valid.select("nome").count() == 2 and rejected.select("nome").count() == 3


def test_every_xml_record_is_valid_or_rejected(spark):
    texts = ["<S><a>1</a><b>x</b></S>", "<S><a>2</a></S>", "<S><a>3</a>", "none", None, "", "<S><a>y</a></S>"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    valid, rejected = reshape.split_xml(df, "t", "a int, b string", {"a": "A", "b": "B"})
    got = {r.n: (r.A, r.B) for r in valid.collect()}
    bad = {r.n: r.t for r in rejected.collect()}
    assert got == {0: (1, "x"), 1: (2, None)} and bad == {n: t for n, t in enumerate(texts) if n > 1}


# --- facts laid out by month ------------------------------------------------------------------------------

@pytest.mark.parametrize("aligned, closed, fwd", [(True, False, 1), (False, False, 0), (True, True, 0), (False, True, 2)])
def test_horizon_reads_its_months_only(spark, tmp_path, aligned, closed, fwd):
    path = str(tmp_path / "fact")
    df = spark.range(4000).select("id", F.expr("if(id % 97 = 0, null, date_add(DATE'2019-01-03', int(id % 900)))").alias("day"), (F.col("id") % 7).alias("k"))
    writers.write_by_month(df, path, "day", ["k"])
    fact = spark.read.parquet(path)
    args = ("day", "2020-05-17", 3, fwd, aligned, closed)
    got = horizon(fact, *args, month=writers.MONTH)
    plan = got._jdf.queryExecution().executedPlan()
    scan = next(line for line in plan.toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(month_start" in scan
    folders = {f.split("month_start=")[1].split("/")[0] for f in got.inputFiles()}
    read = {r[0].split("month_start=")[1].split("/")[0] for r in got.select(F.input_file_name()).distinct().collect()}
    assert read <= {f"2020-{m:02d}-01" for m in range(2, 8)} and len(folders) > len(read)
    want = horizon(df, *args)
    assert rows(got.select("id", "day", "k"), "id") == rows(want, "id") != []
