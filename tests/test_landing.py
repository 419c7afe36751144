from datetime import datetime

import pytest
from pyspark.sql import functions as F

import files
from hostvane import schemas
from hostvane.functions import process_text
from hostvane.operators import processes, series
from hostvane.sources import landing, relational, sinks


@pytest.fixture
def root(tmp_path):
    return files.write_landing(tmp_path)


def test_mixed_versions_in_one_file(spark, tmp_path):
    path = tmp_path / "dados.csv"
    path.write_text(files.text(files.mixed_rows(), files.HEADER))
    samples = landing.read_agent_csv(spark, str(path))
    rows = samples.orderBy("data_hora_iso").collect()
    assert len(rows) == 27
    assert all(r["data_hora_iso"] is not None for r in rows)
    assert [r["qtd_processos"] for r in rows] == [None] * 20 + [0] * 2 + [1] * 5
    assert rows[0]["data_hora_iso"] == files.START
    assert rows[5]["percentual_uso_cpu"] == 5.0 and rows[5]["memoria_total_bytes"] == 34359738368


def test_process_lists_survive_quoting(spark, root):
    samples = landing.read_agent_csv(spark, landing.day_path(root, 2031, 2, 7))
    lists = samples.select(process_text.parse_agent_list(F.col("processos")).alias("p"))
    rows = processes.explode_list(lists, "p", []).collect()
    assert {r["exe"] for r in rows} == {"D:\\Tools (old)\\vela.exe"}
    assert {r["memory_info"]["rss"] for r in rows} == {410000000}
    assert len({r["pid"] for r in rows}) == 5


def test_headerless_and_overlapping_files(spark, root):
    samples = landing.canonical_agent(landing.read_agent_csv(spark, landing.day_path(root, 2031, 2, 7)))
    assert samples.count() == 36
    once = series.drop_repeats(samples)
    assert once.count() == 27
    assert once.agg(F.min("machine")).first()[0] == files.MACHINE


def test_pruned_reading_keeps_the_versions_apart(spark, root):
    """Reading two columns must still tell 26 from 27 fields."""
    samples = landing.read_agent_csv(spark, landing.day_path(root, 2031, 2, 7))
    assert samples.select("data_hora_iso").where("data_hora_iso is null").count() == 0
    assert samples.where("qtd_processos = 1").count() == 10


def test_bad_cells_become_null(spark, tmp_path):
    row = files.agent_fields(0)
    row[2], row[6] = "alto", "1e30"
    (tmp_path / "a.csv").write_text(files.text([row]))
    [read] = landing.read_agent_csv(spark, str(tmp_path)).collect()
    assert read["percentual_uso_cpu"] is None and read["memoria_total_bytes"] is None
    assert read["nome_usuario"] == "bruno"


def test_object_names(spark, root):
    files_read = landing.with_object_name(spark.read.text(landing.day_path(root, 2031, 2, 7)))
    rows = files_read.groupBy("ano", "mes", "dia", "upload_ts", "id_maquina").count().orderBy("upload_ts").collect()
    assert [tuple(r) for r in rows] == [
        ("2031", "02", "07", datetime(2031, 2, 7, 6, 12), files.MACHINE, 21),
        ("2031", "02", "07", datetime(2031, 2, 7, 6, 13), files.MACHINE, 7),
        ("2031", "02", "07", datetime(2031, 2, 7, 6, 14), files.MACHINE, 9),
    ]


def test_other_names_have_no_keys(spark):
    frame = spark.createDataFrame([("s3/raw/outro.csv",)], "p string")
    row = landing.with_object_name(frame, F.col("p")).first()
    assert row["ano"] is None and row["upload_ts"] is None and row["id_maquina"] is None


def test_list_objects(spark, root):
    listed = landing.list_objects(spark, root).collect()
    assert len(listed) == 3 and all(r["length"] > 0 for r in listed)


def test_simulated_file(spark, tmp_path):
    names = [n for n, _ in schemas.SIMULATED_COLUMNS]
    values = ["aa:bb:cc:dd:ee:ff", "u", "27.5", "2100", "1200", "4200", "61.3", "100", "200", "79"]
    values += [str(64 * 1024**3), str(16 * 1024**3), "[{'pid': 1, 'name': 'a,b'}]", "2026-04-01T00:01:00"]
    (tmp_path / "df.csv").write_text(files.text([values], names))
    sample = landing.canonical_simulated(landing.read_simulated_csv(spark, str(tmp_path / "df.csv"))).first()
    assert (sample["machine"], sample["ts"]) == ("aabbccddeeff", datetime(2026, 4, 1, 0, 1))
    assert (sample["ram_free_pct"], sample["ram_used_pct"]) == (79.0, 75.0)
    assert sample["processes"] == "[{'pid': 1, 'name': 'a,b'}]"
    assert sample["ping_ms"] is None


def test_variant_file(spark, tmp_path):
    names = [n for n, _ in schemas.VARIANT_COLUMNS]
    values = ["u", "10.0", "1800", "400", "4200", "50.0", "1", "2", "40", "1000", "400", "93482342.12", "1.5", "12.9"]
    values += ["2026-04-01T00:01:00.5", "[]"]
    (tmp_path / "v.csv").write_text(files.text([values], names))
    sample = landing.canonical_variant(landing.read_variant_csv(spark, str(tmp_path / "v.csv"))).first()
    assert (sample["machine"], sample["ping_ms"], sample["download_bps"]) == ("u", 12, 93482342)


def test_treated_file(spark, tmp_path):
    text = "cpu,disco,datahora,ram_percentual,status_ram,status_cpu,status_disco,periodo\n"
    text += "63.25,17.5,2031-02-07 15:10:20.125000,33.75,ALTO,BAIXO,NORMAL,TARDE\n"
    (tmp_path / "t.csv").write_text(text)
    [row] = landing.read_treated_csv(spark, str(tmp_path / "t.csv")).collect()
    assert row["datahora"] == datetime(2031, 2, 7, 15, 10, 20, 125000) and row["periodo"] == "TARDE"


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.createDataFrame([(1, 'a "q", b')], "id int, t string")
    sinks.append_csv(frame, path)
    sinks.append_csv(frame, path)

    def read():
        rows = spark.read.schema("id int, t string").options(header="true", escape='"').csv(path)
        return [tuple(r) for r in rows.collect()]

    assert read() == [(1, 'a "q", b')] * 2
    sinks.overwrite_csv(frame, path)
    assert read() == [(1, 'a "q", b')]


def test_curated_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "curated")
    rows = [(f"m{i % 7}", datetime(2026, 4, 1 + i % 3, i % 24)) for i in range(300)]
    sinks.write_by_day(spark.createDataFrame(rows, "machine string, ts timestamp"), path)
    day = spark.read.parquet(path).where("ano = 2026 and mes = 4 and dia = 2")
    assert day.count() == 100
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_curated_write_rebalances(spark):
    frame = spark.createDataFrame([("m", datetime(2026, 4, 1))], "machine string, ts timestamp")
    plan = sinks.with_date_keys(frame).hint("rebalance", "ano", "mes", "dia")._jdf.queryExecution().executedPlan()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan.toString()


def test_limits(spark, tmp_path):
    rows = [("m", "cpu", 80.0), ("m", "disk", 90.0), ("n", "ram", 70.0)]
    spark.createDataFrame(rows, schemas.LIMITS_SCHEMA).write.parquet(str(tmp_path / "l"))
    wide = relational.wide_limits(relational.read_limits(spark, str(tmp_path / "l")))
    assert {r["machine"]: tuple(r)[1:] for r in wide.collect()} == {"m": (80.0, None, 90.0), "n": (None, 70.0, None)}


def test_profiles(spark, tmp_path):
    names = ["name", "cpu", "mem_mb", "disk_kbps", "lat_min", "lat_max", "crash", "startup_fail", "hang"]
    (tmp_path / "p.csv").write_text(files.text([["svc", "10", "64", "64", "30", "120", "0.002", "0.02", "0.001"]], names))
    assert relational.read_profiles(spark, str(tmp_path / "p.csv")).first()["hang"] == 0.001


def test_jdbc_options():
    options = relational.jdbc_options("jdbc:mysql://db/limits", "limits", "reader", "secret", "id", (1, 1000), 8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "1000"
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:mysql://db/limits", "limits", partition_column="id")
