"""Upserts, surrogate keys, samples, cleaning and sources."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.functions.text_hash import seeded_hash
from basketlab.operators import cleanse, sampling, staging, star, surrogates, upserts
from basketlab.sources import product_csv, report_json, tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_and_inserts(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, name string, v long")
    new = spark.createDataFrame([(2, "B", 21), (3, "C", 30)], "k long, name string, v long")
    assert rows(upserts.upsert(old, new, ["k"])) == [(1, "a", 10), (2, "B", 21), (3, "C", 30)]
    assert rows(upserts.upsert(old, new, ["k"], ["v"])) == [(1, "a", 10), (2, "b", 21), (3, "C", 30)]
    assert rows(upserts.insert_ignore(old, new, ["k"])) == [(1, "a", 10), (2, "b", 20), (3, "C", 30)]


def test_upsert_can_set_null(spark):
    old = spark.createDataFrame([(1, 10)], "k long, v long")
    new = spark.createDataFrame([(1, None)], "k long, v long")
    assert rows(upserts.upsert(old, new, ["k"], ["v"])) == [(1, None)]


def test_upsert_on_two_keys(spark):
    old = spark.createDataFrame([("x", "y", 1), ("x", "z", 2)], "a string, b string, v long")
    new = spark.createDataFrame([("x", "z", 9)], "a string, b string, v long")
    assert rows(upserts.upsert(old, new, ["a", "b"], ["v"])) == [("x", "y", 1), ("x", "z", 9)]


def test_keys_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 3).repartition(7).withColumn("name", F.concat(F.lit("n"), "id"))
    keyed = surrogates.assign_keys(df, "key", ["id"], start=10)
    got = [(r.key, r.id, r.name) for r in keyed.orderBy("id").collect()]
    assert got == [(10 + i, v, f"n{v}") for i, v in enumerate(range(0, 5000, 3))]
    assert surrogates.assign_keys(df.filter("id < 0"), "key", ["id"]).count() == 0


def test_stage_uses_the_shared_folder(spark):
    folder = staging.shared_folder(spark)
    df = staging.stage(spark.range(5).withColumn("a", F.array("id")), "numbers")
    assert rows(df) == [(i, [i]) for i in range(5)]
    assert all(f"{folder}/basketlab/numbers-" in f for f in df.inputFiles())


def test_only_a_local_session_gets_its_own_folder(spark, monkeypatch):
    monkeypatch.setattr(staging, "configured_folder", lambda session: None)
    folder = staging.shared_folder(spark)
    assert folder == staging.shared_folder(spark)
    assert staging.stage(spark.range(3), "numbers").count() == 3

    class Cluster:
        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Cluster)


@pytest.mark.parametrize("digits", [1, 2, 4])
@pytest.mark.parametrize("rate", [0.0, 0.15, 0.5, 0.999])
def test_stratified_sample_is_exact(spark, digits, rate):
    tickets = spark.range(700).select(
        F.col("id").alias("ticket_id"), F.when(F.col("id") % 7 == 0, "rare").otherwise("common").alias("season")
    )
    got = {r.ticket_id for r in sampling.stratified_sample(tickets, rate, seed=3, digits=digits).collect()}
    order = tickets.withColumn("h", seeded_hash(F.col("ticket_id"), 3)).collect()
    want = set()
    for season in ("rare", "common"):
        ranked = sorted((r.h, r.ticket_id) for r in order if r.season == season)
        want |= {ticket for _, ticket in ranked[: int(Decimal(len(ranked)) * Decimal(str(rate)))]}
    assert got == want


def test_full_sample_keeps_all(spark):
    tickets = spark.range(10).select(F.col("id").alias("ticket_id"), F.lit("x").alias("season"))
    assert sampling.stratified_sample(tickets, 1.0).count() == 10
    assert sampling.simple_sample(tickets, 1.0).count() == 10
    assert sampling.simple_sample(tickets, 0.0).count() == 0


def test_headers_and_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["  Identificador ", "Precio \t Neto"])
    assert cleanse.normalize_headers(df).columns == ["identificador", "precio_neto"]
    with pytest.raises(ValueError, match="categoria"):
        cleanse.require_columns(cleanse.normalize_headers(df), ["identificador", "categoria"])


def test_reject_bad_rows(spark):
    df = spark.createDataFrame([(1, "$1,000.005"), (2, "free"), (3, None)], "id long, text string")
    good, bad = cleanse.reject_bad_rows(df, "text")
    assert rows(good.select("id", "price")) == [(1, Decimal("1000.01"))]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_frequency_labels(spark):
    products = spark.range(20_000).select(F.col("id").alias("product_id"))
    labelled = cleanse.fill_frequency(products)
    shares = {r.frequency: r["count"] / 20_000 for r in labelled.groupBy("frequency").count().collect()}
    assert shares == pytest.approx(cleanse.FREQUENCY_SHARES, abs=0.02)
    assert cleanse.fill_frequency(labelled) is labelled
    odd = spark.createDataFrame([("Regular",), ("??",), (None,)], "f string")
    assert [r[0] for r in odd.select(cleanse.frequency_weight(F.col("f"))).collect()] == [0.20, 0.15, 0.15]


def test_anchor_products_fall_back_to_all(spark):
    products = spark.createDataFrame([(1, "Hogar"), (2, "Otros")], "product_id long, category string")
    assert rows(cleanse.anchor_products(products)) == [(1, "Hogar")]
    assert cleanse.anchor_products(products, ["Nada"]).count() == 2


def test_ticket_totals(spark):
    lines = spark.createDataFrame(
        [(1, Decimal("1.10"), 2), (1, Decimal("2.20"), 1), (2, Decimal("0.00"), 1), (3, Decimal("5.00"), 0)],
        "ticket_id long, amount decimal(10,2), quantity long",
    )
    assert rows(cleanse.ticket_totals(lines)) == [(1, Decimal("3.30"), 3)]


def test_resolve_ticket_ids_drops_unknown(spark):
    lines = spark.createDataFrame([("u1", 5), ("u2", 6), ("u1", 7)], "external_uuid string, product_id long")
    tickets = spark.createDataFrame([(10, "u1")], "ticket_id long, external_uuid string")
    assert rows(cleanse.resolve_ticket_ids(lines, tickets).select("ticket_id", "product_id")) == [(10, 5), (10, 7)]


def test_categories_list_every_product_once(spark):
    products = spark.range(500).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), "id").alias("product_name"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        F.when(F.col("id") < 400, "big").otherwise("small").alias("category"),
    )
    listed = cleanse.products_by_category(products).collect()
    assert sorted((r.product_id, r.category, r.n_products) for r in listed) == [
        (k, "big", 400) if k < 400 else (k, "small", 100) for k in range(500)]


def test_products_with_repeated_ids_or_empty_fields_are_rejected(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    head = "Identificador,Producto,Precio,Categoria\n"
    (folder / "a.csv").write_bytes((head + "1,Niño,2.50,Hogar\n2,dos,1,\n3,,1,Hogar\n4,x,1,A\n").encode())
    (folder / "b.csv").write_bytes((head + "5,Señal,2.50,Hogar\n4,y,2,A\n6,z,free,A\n").encode("latin-1"))
    good, bad = product_csv.read_products_csv(spark, str(folder))
    assert sorted((r.product_id, r.product_name) for r in good.collect()) == [(1, "Niño"), (5, "Señal")]
    assert sorted(r.identificador for r in bad.collect()) == ["2", "3", "4", "4", "6"]


def test_repeated_keys_fail(spark):
    rows = spark.createDataFrame([(1, "a", "c", 1), (1, "b", "c", 1)], "product_id long, product_name string, category string, price int")
    old = rows.limit(0)
    with pytest.raises(Exception, match="repeated key"):
        upserts.upsert(old, rows, ["product_id"]).collect()
    with pytest.raises(Exception, match="repeated key"):
        star.dim_product(rows).collect()


def test_staged_tables_can_be_removed(spark):
    from pathlib import Path

    before = len(staging.staged_paths(spark))
    staging.stage(spark.range(3), "gone")
    path = staging.staged_paths(spark)[-1]
    assert Path(path.removeprefix("file:")).exists()
    assert staging.remove_staged(spark, before) == 1 and not Path(path.removeprefix("file:")).exists()


def test_wide_rows_do_not_pile_up_in_one_page(spark):
    """Forty rows of 300,000 bytes; the first page's header says how many bytes it has."""
    from pathlib import Path

    import pyarrow.parquet as pq

    wide = spark.range(40, numPartitions=1).select(F.expr("transform(sequence(1, 37500), i -> hex(xxhash64(id, i)))").alias("a"))
    table = staging.stage(wide.select(F.array_join("a", "").alias("a")), "wide_rows")
    file = next(Path(table.path.removeprefix("file:")).glob("part-*"))
    header = file.read_bytes()[pq.ParquetFile(file).metadata.row_group(0).column(0).data_page_offset:][:20]
    assert header[0] == header[2] == 0x15  # the page's type, then its bytes as zigzag number
    size = shift = 0
    for byte in header[3:]:
        size, shift = size | (byte & 127) << shift, shift + 7
        if byte < 128:
            break
    assert 0 < size >> 1 < 4 << 20
    assert table.count() == 40


def test_python_gets_batches_of_bounded_rows(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    with staging.arrow_batches(spark, 3):
        found = staging.stage(spark.range(20, numPartitions=2).mapInArrow(sizes, "n long"), "batch_sizes")
    assert rows(found) == [(1,)] * 2 + [(3,)] * 6 and spark.conf.get(key) == usual


def test_tables_that_are_read_no_more_are_deleted(spark):
    from pathlib import Path

    table = staging.stage(spark.range(3), "read_once")
    staging.unstage(table)
    assert table.path not in staging.staged_paths(spark) and not Path(table.path.removeprefix("file:")).exists()


def test_no_temporary_folder_for_several_processes(monkeypatch):
    class Context:
        master, applicationId = "local-cluster[2,1,1024]", "a"

    class Session:
        sparkContext = Context

    monkeypatch.setattr(staging, "configured_folder", lambda spark: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session)


def test_conform_casts_defaults_and_nulls(spark):
    df = spark.createDataFrame([("1", "a", "2.5", None)], "product_id string, product_name string, price string, category string")
    out = tables.conform(df, schemas.PRODUCTS, {"category": "none"}).first()
    assert (out.product_id, out.price, out.frequency, out.category) == (1, Decimal("2.50"), None, "none")
    with pytest.raises(Exception, match="NULL in required column category"):
        tables.conform(df, schemas.PRODUCTS).collect()
    with pytest.raises(ValueError, match="price"):
        tables.conform(df.drop("price"), schemas.PRODUCTS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.conform(df.withColumn("price", F.lit("x")), schemas.PRODUCTS, {"category": "c"}).collect()


def test_rule_defaults(spark):
    columns = [f.name for f in schemas.RULES.fields if f.name not in schemas.RULE_DEFAULTS]
    one = spark.range(1).select(*[F.lit("1").alias(c) for c in columns])
    row = tables.conform(one, schemas.RULES, schemas.RULE_DEFAULTS).first()
    assert (row.conviction, row.source) == (999999.0, "APRIORI")


def test_overwrite_append_and_pruned_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), path)
    assert tables.overwrite_table(spark.range(5).withColumn("x", F.lit(1)), path).count() == 5
    tables.append_batches(path, spark.range(2).withColumn("x", F.lit(2)), spark.range(1).withColumn("x", F.lit(3)))
    read = tables.read_table(spark, path, ["x"])
    assert sorted(r.x for r in read.collect()) == [1, 1, 1, 1, 1, 2, 2, 3]
    assert "ReadSchema: struct<x:int>" in read._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    for name in ("a", "b"):
        df = spark.range(1000).select((F.col("id") % 100).alias("ticket_id"), F.col("id").alias(name))
        tables.save_bucketed(df, f"bucketed_{name}", str(tmp_path / name), ["ticket_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "ticket_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


CSV = 'Identificador , PRODUCTO,Precio, Categoria\n1,"Café, molido","$1,234.565",Hogar\n2,"Taza ""azul""",10,Hogar\n3,Roto,abc,Hogar\nx4,Sin id,5,Hogar\n'


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_read_products_csv(spark, tmp_path, encoding):
    path = write(tmp_path / "p.csv", CSV, encoding)
    good, bad = product_csv.read_products_csv(spark, path)
    assert [f.name for f in good.schema] == [f.name for f in schemas.PRODUCTS]
    assert rows(good.select("product_id", "product_name", "price", "category")) == [
        (1, "Café, molido", Decimal("1234.57"), "Hogar"), (2, 'Taza "azul"', Decimal("10.00"), "Hogar"),
    ]
    assert {r.frequency for r in good.collect()} <= set(cleanse.FREQUENCY_SHARES)
    assert sorted(r.producto for r in bad.collect()) == ["Roto", "Sin id"]


def test_csv_keeps_its_frequency_column(spark, tmp_path):
    path = write(tmp_path / "p.csv", "identificador,producto,precio,categoria,frecuencia\n1,a,2,b,Regular\n")
    assert product_csv.read_products_csv(spark, path)[0].first().frequency == "Regular"


def test_records_with_other_field_counts_are_rejected_whole(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    head = "Identificador,Producto,Precio,Categoria\n"
    lines = ["1,Mesa,10.00,Hogar", "2,Silla, roja,20.00,Hogar", '3,"Silla, azul",20.00,Hogar', "4,Lámpara,5.00", "5", "6,a,1,b,", "7,Cama,30,Hogar"]
    (folder / "a.csv").write_bytes((head + "\n".join(lines) + "\n\n").encode())
    (folder / "b.csv").write_bytes((head + "8,Señal,1.00,Hogar\n9,Baño,2,3,4\n").encode("latin-1"))
    good, bad = product_csv.read_products_csv(spark, str(folder))
    assert sorted((r.product_id, r.product_name, r.category) for r in good.collect()) == [
        (1, "Mesa", "Hogar"), (3, "Silla, azul", "Hogar"), (7, "Cama", "Hogar"), (8, "Señal", "Hogar")]
    assert sorted(r.whole_record for r in bad.collect()) == sorted([lines[1], lines[3], lines[4], lines[5], "9,Baño,2,3,4"])


def test_a_shifted_number_is_not_taken_for_a_price(spark, tmp_path):
    path = write(tmp_path / "p.csv", "identificador,producto,precio,categoria\n1,a,9,b\n2,Silla,3,20.00,Hogar\n")
    good, bad = product_csv.read_products_csv(spark, path)
    assert [r.product_id for r in good.collect()] == [1]
    assert [(r.identificador, r.whole_record) for r in bad.collect()] == [("2", "2,Silla,3,20.00,Hogar")]


def test_records_over_lines_and_a_header_named_like_the_record(spark, tmp_path):
    text = 'identificador,producto,precio,categoria,WHOLE_RECORD\n1,"a\nb",9,c,x\n2,"d\ne",9\n'
    good, bad = product_csv.read_products_csv(spark, write(tmp_path / "p.csv", text), multi_line=True)
    assert [(r.product_id, r.product_name) for r in good.collect()] == [(1, "a\nb")]
    assert [r.whole_record_ for r in bad.collect()] == ['2,"d\ne",9']


def test_files_with_different_headers_stop_the_load(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("identificador,producto,precio,categoria\n1,a,9,b\n")
    (folder / "b.csv").write_text("identificador,categoria,precio,producto\n2,a,9,b\n")
    with pytest.raises(Exception, match="header"):
        product_csv.read_products_csv(spark, str(folder))


def test_a_repeated_id_on_most_rows(spark, tmp_path):
    text = "identificador,producto,precio,categoria\n" + "5,x,1,y\n" * 400 + "1,a,9,b\n"
    good, bad = product_csv.read_products_csv(spark, write(tmp_path / "p.csv", text))
    assert [r.product_id for r in good.collect()] == [1] and bad.count() == 400


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        product_csv.read_products_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="missing columns"):
        product_csv.read_products_csv(spark, write(tmp_path / "a.csv", "identificador,producto,precio\n1,a,2\n"))
    with pytest.raises(ValueError, match="no rows"):
        product_csv.read_products_csv(spark, write(tmp_path / "b.csv", "identificador,producto,precio,categoria\n"))


def test_report_json(spark, tmp_path):
    report = spark.createDataFrame(
        [(1, "Niño", Decimal("1.50"), date(2024, 1, 2))], "product_a long, name_a string, lift decimal(10,2), run_date date"
    )
    path = str(tmp_path / "r")
    with pytest.warns(UserWarning, match="categoria_proximidad"):
        report_json.write_report_json(spark, {"basket": report, "category": spark.createDataFrame([], schemas.CATEGORY_PAIRS)}, path)
    names = ["market_basket_analysis", "categoria_proximidad"]
    row = "struct<producto_a_key:long,nombre_a:string,lift:double,fecha_calculo:string>"
    found = report_json.read_report_json(spark, path, names, row).select("report", "position", "row.*").collect()
    assert [tuple(r) for r in found] == [("market_basket_analysis", 0, 1, "Niño", 1.5, "2024-01-02")]


def test_one_document_holds_all_reports_in_order(spark, tmp_path):
    first = spark.createDataFrame([(3, Decimal("1.50"), date(2024, 1, 31), 'say "hé"'), (1, None, None, None)], "k long, v decimal(5,2), d date, t string")
    path = str(tmp_path / "reports.json")
    for _ in range(2):  # the second one replaces the first
        report_json.write_report_document(spark, {"b": first, "a": first.filter("k > 5")}, path, published=False)
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    assert list(content) == ["b", "a"] and content["a"] == []
    assert content["b"] == [{"k": 3, "v": 1.5, "d": "2024-01-31", "t": 'say "hé"'}, {"k": 1, "v": None, "d": None, "t": None}]
    with pytest.raises(ValueError, match="more than 1 rows"):
        report_json.write_report_document(spark, {"b": first}, str(tmp_path / "none.json"), published=False, most_rows=1)
    assert not (tmp_path / "none.json").exists()


def test_report_json_writes_long_tables(spark, tmp_path):
    report_json.write_report_json(spark, {"basket": spark.range(30_000).withColumnRenamed("id", "product_a")}, str(tmp_path / "r"))
    found = report_json.read_report_json(spark, str(tmp_path / "r"), ["market_basket_analysis"], "struct<producto_a_key:long>")
    assert found.count() == 30_000


def test_published_names_both_ways(spark):
    for table, (_, names) in schemas.PUBLISHED.items():
        assert len(set(names.values())) == len(names), table
        df = spark.createDataFrame([tuple(names)], list(names))
        assert schemas.from_published(schemas.to_published(df, table), table).columns == list(names)
