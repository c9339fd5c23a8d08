"""CSV rules, idempotent loads, calendar order, replay and the stream, on small files."""

from __future__ import annotations

import datetime as dt
import gzip
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import HistoryTable
from tidemark.plans import marts, silver
from tidemark.session import freed_shuffles
from tidemark.sources import load
from tidemark.sources.paths import read_if_present
from tidemark.sources.raw import has_split_cells, overlong_lines, read_raw_csv
from tidemark.sources.schemas import AREAS, COUNTS, LISTINGS, MEDIANS, RAW_TABLES
from tidemark.streaming.incremental import IncrementalWarehouse, run_incremental


def listing(**cells):
    base = {
        "listing_id": "1", "scrape_id": "9", "scraped_date": "2020-05-10", "host_id": "7",
        "host_name": "Ann", "host_since": "3/7/2014", "host_is_superhost": "t",
        "host_neighbourhood": "Bondi", "listing_neighbourhood": "Sydney",
        "property_type": "Flat", "room_type": "Entire", "accommodates": "2", "price": "100.0",
        "has_availability": "t", "availability_30": "10", "number_of_reviews": "3",
    }
    return {**base, **cells}


def write_month(folder, name, rows):
    lines = [",".join(LISTINGS)]
    lines += [",".join(str(row.get(c, "")) for c in LISTINGS) for row in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def areas(spark):
    row = (11, "Sydney", "SYDNEY", dt.date(1900, 1, 1), dt.date(9999, 12, 31), True)
    return spark.createDataFrame(
        [row],
        "lga_code INT, lga_name STRING, lga_name_key STRING, valid_from DATE, valid_to DATE, "
        "is_current BOOLEAN",
    )


def test_raw_schemas():
    assert len(LISTINGS) == 22 and len(COUNTS) == 109 and len(MEDIANS) == 9
    assert COUNTS[1:4] == ("tot_p_m", "tot_p_f", "tot_p_p")
    assert set(RAW_TABLES) == {
        "raw_listings", "raw_census_g01", "raw_census_g02", "raw_lga_code", "raw_lga_suburb"
    }


def test_csv_cells_headers_and_missing_values(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text(
        ' LGA_NAME ,Lga_Code,,\n"a, ""b""\nc",1,,\nNA,2,,\n"",3,,\n  x ,007,,\nN/A,null,,\n'
    )
    df = read_raw_csv(spark, str(path), AREAS)
    assert df.columns == ["lga_code", "lga_name", "source_file", "loaded_at"]
    got = [(r.lga_code, r.lga_name) for r in df.collect()]
    assert got == [
        ("1", 'a, "b"\nc'), ("2", None), ("3", None), ("007", "  x "), (None, None),
    ]
    assert {r.source_file for r in df.collect()} == {"codes.csv"}


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lga_name,lga_code\nx,1\n")
    (tmp_path / "b.csv").write_text("lga_code\n2\n")
    df = read_raw_csv(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], AREAS)
    assert {(r.lga_code, r.lga_name) for r in df.collect()} == {("1", "x"), ("2", None)}
    (tmp_path / "c.csv").write_text("lga_code,surprise\n2,3\n")
    with pytest.raises(ValueError, match="surprise"):
        read_raw_csv(spark, str(tmp_path / "c.csv"), AREAS)


def test_swapped_headers_inside_a_folder_never_swap_cells(spark, tmp_path):
    (tmp_path / "1.csv").write_text("lga_name,lga_code\nx,1\n")
    (tmp_path / "2.csv").write_text("lga_code,lga_name\n2,y\n")
    each = read_raw_csv(spark, [str(tmp_path / n) for n in ("1.csv", "2.csv")], AREAS)
    assert {(r.lga_code, r.lga_name) for r in each.collect()} == {("1", "x"), ("2", "y")}
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path), AREAS).collect()


def test_headers_with_blanks_are_read_file_by_file(spark, tmp_path):
    (tmp_path / "1.csv").write_text("lga_name,lga_code,,\nx,1,,\n")
    (tmp_path / "2.csv").write_text("lga_code,lga_name,,\n2,y,,\n")
    df = read_raw_csv(spark, str(tmp_path), AREAS)
    assert {(r.lga_code, r.lga_name) for r in df.collect()} == {("1", "x"), ("2", "y")}


def test_files_with_one_header_are_one_scan(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"lga_name,lga_code\nx,{k}\n")
    df = read_raw_csv(spark, [str(tmp_path / f"{k}.csv") for k in range(3)], AREAS)
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 3


@pytest.mark.parametrize("multi_line", [True, False])
def test_lines_with_too_many_cells(spark, tmp_path, multi_line):
    path = tmp_path / "codes.csv"
    path.write_text('lga_name,lga_code\n"a,b",1\nx,2,EXTRA\ny\nz,3,\n"q ""r"", s",4\n')
    with pytest.raises(Exception, match="too many cells"):
        read_raw_csv(spark, str(path), AREAS, multi_line).collect()
    kept = read_raw_csv(spark, str(path), AREAS, multi_line, on_long="skip")
    got = sorted((r.lga_name, r.lga_code) for r in kept.collect())
    assert got == [("a,b", "1"), ('q "r", s', "4"), ("y", None)]
    lines = overlong_lines(spark, str(path), multi_line).collect()
    assert sorted(r.line.strip() for r in lines) == ["x,2,EXTRA", "z,3,"]
    assert {r.source_file for r in lines} == {"codes.csv"}


def test_a_reload_that_fails_keeps_the_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    load.load_file(rows_of(spark, "05_2020.csv", "1", "2"), table, "05_2020.csv")
    broken = rows_of(spark, "05_2020.csv", "3", "x").withColumn(
        "code", F.when(F.col("code") == "x", F.raise_error(F.lit("half-way"))).otherwise("3")
    )
    with pytest.raises(Exception, match="half-way"):
        load.load_file(broken, table, "05_2020.csv")
    assert codes(spark, table) == [("05_2020.csv", "1"), ("05_2020.csv", "2")]


def rows_of(spark, name, *codes):
    return spark.createDataFrame([(c, name) for c in codes], "code STRING, source_file STRING")


def codes(spark, table):
    return sorted((r.source_file, r.code) for r in load.read_table(spark, table).collect())


def test_loading_a_file_replaces_only_its_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    load.load_file(rows_of(spark, "05_2020.csv", "1", "2"), table, "05_2020.csv")
    load.load_file(rows_of(spark, "06_2020.csv", "3"), table, "06_2020.csv")
    twice = rows_of(spark, "05_2020.csv", "4")
    for _ in range(2):
        load.load_file(twice, table, "05_2020.csv")
    assert codes(spark, table) == [("05_2020.csv", "4"), ("06_2020.csv", "3")]
    # an empty file takes its old rows away and no longer counts as loaded
    load.load_file(twice.limit(0), table, "05_2020.csv")
    assert codes(spark, table) == [("06_2020.csv", "3")]
    assert not load.is_loaded(spark, table, "05_2020.csv")
    assert [r[0] for r in load.loaded_files(spark, table).collect()] == ["06_2020.csv"]


def test_static_files_load_once(spark, tmp_path):
    table = str(tmp_path / "t")
    assert load.load_if_absent(rows_of(spark, "codes.csv", "1"), table, "codes.csv")
    assert not load.load_if_absent(rows_of(spark, "codes.csv", "2"), table, "codes.csv")
    assert codes(spark, table) == [("codes.csv", "1")]


def names(spark, *files):
    return spark.createDataFrame([(f,) for f in files], "source_file STRING")


def test_periods_come_in_calendar_order_and_late_ones_are_refused(spark):
    available = names(spark, "12_2020.csv", "01_2021.csv", "05_2020.csv", "06_2020.csv")
    nothing = names(spark)
    pending = load.pending_periods(available, nothing)
    order = [r.source_file for r in pending.collect()]
    assert order == ["05_2020.csv", "06_2020.csv", "12_2020.csv", "01_2021.csv"]
    assert load.next_period(pending, nothing) == "05_2020.csv"
    loaded = names(spark, "05_2020.csv", "12_2020.csv")
    with pytest.raises(ValueError, match="06_2020.csv is older"):
        load.next_period(load.pending_periods(available, loaded), loaded)
    assert load.next_period(load.pending_periods(available, available), available) is None


def test_files_are_listed_by_name(spark, tmp_path):
    for name in ("05_2020.csv", "note.txt"):
        (tmp_path / name).write_text("x\n")
    assert [r.source_file for r in load.list_files(spark, str(tmp_path)).collect()] == ["05_2020.csv"]


def test_one_row_per_listing_and_month(spark, tmp_path):
    """The month is the file's; the latest scrape wins; a missing scrape date comes first."""
    write_month(tmp_path, "07_2020.csv", [
        listing(scraped_date="2020-07-14", price="1"),
        listing(scraped_date="2020-09-05", price="2"),
        listing(listing_id="2", scraped_date="", price="3"),
        listing(listing_id="2", scraped_date="2020-08-01", price="4"),
        listing(listing_id="1.1156E+4", host_id="7.0", accommodates="2.5", has_availability=""),
    ])
    raw = read_raw_csv(spark, str(tmp_path / "07_2020.csv"), LISTINGS)
    rows = {r.listing_id: r for r in silver.clean_listings(raw).collect()}
    assert set(rows) == {1, 2, 11156}
    assert {r.month_date for r in rows.values()} == {dt.date(2020, 7, 1)}
    assert float(rows[1].price) == 2 and float(rows[2].price) == 3
    odd = rows[11156]
    assert (odd.host_id, odd.accommodates, odd.has_availability) == (7, 3, None)
    assert odd.host_since == dt.date(2014, 7, 3)


@pytest.mark.parametrize("hot", [[], [1]])
def test_listings_of_a_month_lie_in_a_few_parts(spark, tmp_path, hot):
    """The same rows after one shuffle, which has the months of the table to be written."""
    for name in ("07_2020.csv", "08_2020.csv"):
        rows = [
            listing(listing_id="" if i == 29 else i % 9, scraped_date=f"2020-07-{i % 5 + 1:02}", price=i)
            for i in range(30)
        ]
        write_month(tmp_path, name, rows)
    raw = read_raw_csv(spark, str(tmp_path), LISTINGS, multi_line=False)
    raw = raw.withColumn("loaded_at", F.lit(dt.datetime(2020, 9, 1)))
    want = sorted(map(str, silver.clean_listings(raw).collect()))
    dealt = silver.clean_listings(raw, hot=hot, parts=2)
    assert sorted(map(str, dealt.collect())) == want and len(want) == 20
    placed = dealt.select("month_date", F.spark_partition_id().alias("task"))
    tasks = placed.groupBy("month_date").agg(F.count_distinct("task").alias("n"))
    assert all(r.n <= 2 for r in tasks.collect())
    plan = dealt.repartition(1)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [month_date" in plan


def test_rows_that_are_together_are_loaded_without_a_shuffle(spark, tmp_path):
    for k, name in enumerate(("07_2020.csv", "08_2020.csv")):
        write_month(tmp_path, name, [listing(listing_id=i + k) for i in range(5)])
    raw = read_raw_csv(spark, str(tmp_path), LISTINGS, multi_line=False)
    for gathered in (False, True):
        load.load_files(raw, str(tmp_path / f"t{gathered}"), gathered)
    stored = [load.read_table(spark, str(tmp_path / f"t{g}")).drop("loaded_at") for g in (False, True)]
    assert sorted(map(str, stored[0].collect())) == sorted(map(str, stored[1].collect()))


def test_packed_files_have_their_own_names(spark, tmp_path):
    """Monthly and reference files packed by gzip, alone or as parts of a folder."""
    source = tmp_path / "in"
    (source / "file=12_2020.csv").mkdir(parents=True)
    for name, rows in list(MONTHS.items()):
        write_month(tmp_path, name, rows)
        at = "file=12_2020.csv/part-0.csv.gz" if name == "12_2020.csv" else f"{name}.gz"
        (source / at).write_bytes(gzip.compress((tmp_path / name).read_bytes()))
    codes = gzip.compress(b"lga_code,lga_name\n11,Sydney\n")
    (source / "lga_code_1.csv.gz").write_bytes(codes)
    warehouse = IncrementalWarehouse(
        spark, str(tmp_path / "out"), clock=lambda: dt.datetime(2020, 5, 20), wanted_marts=()
    )
    run_incremental(warehouse, str(source))
    assert facts(warehouse) == EXPECTED
    assert versions(warehouse) == HOST_VERSIONS
    assert sorted(r[0] for r in warehouse.finished().collect()) == sorted(MONTHS)
    assert [r[0] for r in load.loaded_files(spark, f"{tmp_path}/out/bronze/raw_lga_code").collect()] == [
        "lga_code_1.csv"
    ]


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    def shuffles():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
        files = manager.diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(setting), shuffles()
    with freed_shuffles(spark):
        rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        rows.write.parquet(str(tmp_path / "t"))
    for _ in range(50):
        if not (left := {f for f in shuffles() - before if f.startswith("shuffle_")}):
            break
        time.sleep(0.1)
    assert not left and spark.read.parquet(str(tmp_path / "t")).count() == 7
    with pytest.raises(ZeroDivisionError), freed_shuffles(spark):
        assert spark.conf.get(setting) == "true"
        1 / 0
    assert spark.conf.get(setting) == kept


def test_months_are_brought_together_on_short_rows(spark):
    """The same texts as without; the shuffle has the line items and two names."""
    from tidemark.catalogue import tables as t

    sf_dir = "/root/testdata/sf0.001"
    plain, gathered = t.raw_listings(spark, sf_dir), t.raw_listings(spark, sf_dir, gathered=True)
    assert gathered.columns == plain.columns
    assert gathered.exceptAll(plain).isEmpty() and plain.count() == gathered.count()
    plan = gathered._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("RebalancePartitions", 1)[1]
    assert "scrape_id" not in below and "host_name" not in below


def test_suburb_in_two_areas_takes_the_first(spark):
    raw = spark.createDataFrame(
        [("SYDNEY", "BLACK-TOWN "), ("BAYSIDE", "BLACK-TOWN"), ("NOWHERE", "O'CONNELL"), ("X", None)],
        "lga_name STRING, suburb_name STRING",
    ).withColumn("loaded_at", F.lit("2020-01-01").cast("timestamp"))
    lga = spark.createDataFrame([(1, "Bayside", "BAYSIDE"), (2, "Sydney", "SYDNEY")],
                                "lga_code INT, lga_name STRING, lga_name_key STRING")
    got = {(r.suburb_name, r.lga_code) for r in silver.clean_suburb(raw, lga).collect()}
    assert got == {("Black-Town", 1), ("O'Connell", None)}


MONTHS = {
    "12_2020.csv": [listing(scraped_date="2020-12-10", host_is_superhost="t"), listing(
        listing_id="2", scraped_date="2020-12-11", host_is_superhost="f",
        listing_neighbourhood="SYDNEY")],
    "05_2020.csv": [listing(), listing(listing_id="2", listing_neighbourhood="Elsewhere")],
    "01_2021.csv": [listing(scraped_date="2021-01-10", has_availability="f", price="5001")],
}


def facts(warehouse):
    return sorted(
        (r.listing_id, str(r.month_date), r.lga_code, r.number_of_stays, float(r.estimated_revenue))
        for r in warehouse.fact().collect()
    )


EXPECTED = [
    (1, "2020-05-01", 11, 20, 2000.0),
    (1, "2020-12-01", 11, 20, 2000.0),
    (1, "2021-01-01", 11, 0, 0.0),
    (2, "2020-05-01", None, 20, 2000.0),
    (2, "2020-12-01", 11, 20, 2000.0),
]


def versions(warehouse):
    return sorted(
        (str(r.valid_from), str(r.valid_to), r.host_is_superhost)
        for r in warehouse.hosts.read().collect()
    )


HOST_VERSIONS = [
    ("2020-05-01", "2020-12-01", True),
    ("2020-12-01", "2021-01-01", False),
    ("2021-01-01", "None", True),
]


def test_stream_orders_months_and_diverts_late_ones(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for name, rows in MONTHS.items():
        write_month(source, name, rows)
    warehouse = IncrementalWarehouse(spark, root, areas(spark), wanted_marts=())
    run_incremental(warehouse, str(source))
    assert facts(warehouse) == EXPECTED
    assert versions(warehouse) == HOST_VERSIONS
    run_incremental(warehouse, str(source))  # nothing new
    assert facts(warehouse) == EXPECTED
    write_month(source, "06_2020.csv", [listing()])
    run_incremental(warehouse, str(source), on_late="divert")
    assert facts(warehouse) == EXPECTED
    late = spark.read.parquet(f"{root}/late_files").collect()
    assert [r.source_file for r in late] == ["06_2020.csv"]


def test_late_month_stops_the_run_and_replay_repairs_it(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    warehouse = IncrementalWarehouse(
        spark, str(tmp_path / "out"), areas(spark), wanted_marts=()
    )
    for name in ("05_2020.csv", "01_2021.csv"):
        write_month(source, name, MONTHS[name])
    assert warehouse.process_batch(load.list_files(spark, str(source)), at_once=1) == [
        "05_2020.csv", "01_2021.csv"
    ]
    write_month(source, "12_2020.csv", MONTHS["12_2020.csv"])
    with pytest.raises(ValueError, match="12_2020.csv is older"):
        warehouse.process_batch(load.list_files(spark, str(source)))
    assert warehouse.replay(dt.date(2020, 12, 1)) == ["01_2021.csv"]
    assert [f[1] for f in facts(warehouse)] == ["2020-05-01", "2020-05-01"]
    assert versions(warehouse) == [("2020-05-01", "None", True)]
    assert warehouse.process_batch(load.list_files(spark, str(source))) == [
        "12_2020.csv", "01_2021.csv"
    ]
    assert facts(warehouse) == EXPECTED
    assert versions(warehouse) == HOST_VERSIONS


def test_a_run_after_a_replay_brings_the_forgotten_months_back(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for name, rows in MONTHS.items():
        write_month(source, name, rows)
    warehouse = IncrementalWarehouse(spark, root, areas(spark), wanted_marts=())
    run_incremental(warehouse, str(source))
    kept = {
        path.name: path.stat().st_mtime_ns
        for path in (tmp_path / "out/gold/fact_listings/month_date=2020-05-01").glob("part-*")
    }
    assert warehouse.replay(dt.date(2020, 12, 1)) == ["12_2020.csv", "01_2021.csv"]
    assert [f[1] for f in facts(warehouse)] == ["2020-05-01", "2020-05-01"]
    run_incremental(warehouse, str(source))
    assert facts(warehouse) == EXPECTED
    assert versions(warehouse) == HOST_VERSIONS
    # the months before were not written again
    assert kept == {
        path.name: path.stat().st_mtime_ns
        for path in (tmp_path / "out/gold/fact_listings/month_date=2020-05-01").glob("part-*")
    }


def test_open_versions_of_old_batches_are_removed(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", "at")
    days = [dt.date(2020, m, 1) for m in range(1, 6)]
    for day in days:
        table.apply(spark.createDataFrame([(1, day), (2, day)], "k INT, at DATE"))
    before = sorted(map(tuple, table.read().collect()))
    gone = table.vacuum()
    assert [path.split("/versions/")[1] for path in gone] == [
        f"batch={b}/state=open" for b in (1, 2, 3)
    ]
    assert sorted(map(tuple, table.read().collect())) == before
    assert table.vacuum() == []
    table.cut(dt.date(2020, 3, 1))
    got = sorted((r["k"], str(r["valid_from"]), str(r["valid_to"])) for r in table.read().collect())
    assert got == [
        (k, *bounds) for k in (1, 2)
        for bounds in (("2020-01-01", "2020-02-01"), ("2020-02-01", "None"))
    ]


def test_area_and_suburb_files_make_histories(spark, tmp_path):
    warehouse = IncrementalWarehouse(spark, str(tmp_path / "out"))

    def file(rows, columns, day):
        kind = ", ".join(f"{c} STRING" for c in columns)
        return spark.createDataFrame(rows, kind).withColumn(
            "loaded_at", F.lit(day).cast("timestamp")
        )

    names = ("lga_code", "lga_name")
    with pytest.raises(ValueError, match="no area file"):
        warehouse.load_suburbs(file([], ("lga_name", "suburb_name"), "2020-05-01"), "s1.csv")
    assert warehouse.load_areas(file([("1", "Old")], names, "2020-05-01"), "a1.csv")
    assert not warehouse.load_areas(file([("1", "Other")], names, "2020-06-01"), "a1.csv")
    own = ("lga_name", "suburb_name")
    assert warehouse.load_suburbs(file([("OLD", "Bondi")], own, "2020-05-01"), "s1.csv")
    assert warehouse.load_areas(file([("1", "New"), ("2", "Far")], names, "2020-07-09"), "a2.csv")
    assert warehouse.load_suburbs(file([("FAR", "Bondi")], own, "2020-07-09"), "s2.csv")
    areas_ = sorted(
        (r.lga_code, r.lga_name, str(r.valid_from), str(r.valid_to))
        for r in warehouse.dim_lga().collect()
    )
    assert areas_ == [
        (1, "New", "2020-07-01", "9999-12-31"), (1, "Old", "1900-01-01", "2020-07-01"),
        (2, "Far", "1900-01-01", "9999-12-31"),
    ]
    suburbs_ = sorted(
        (r.suburb_name, r.lga_code, str(r.valid_from)) for r in warehouse.dim_suburb().collect()
    )
    assert suburbs_ == [("Bondi", 1, "1900-01-01"), ("Bondi", 2, "2020-07-01")]


def test_reference_files_come_first_and_marts_follow_the_months(spark, tmp_path):
    """A folder of all kinds of files; marts month by month equal those of the whole fact."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "lga_suburb_1.csv").write_text("LGA_NAME,SUBURB_NAME,\nSYDNEY,BONDI,\n")
    (source / "lga_code_1.csv").write_text("lga_code,lga_name\n11,Sydney\n")
    (source / "census_g01.csv").write_text("lga_code_2016,tot_p_p\nLGA11,7\n")
    (source / "census_g02.csv").write_text("lga_code_2016,median_age_persons\nLGA11,35\n")
    write_month(source, "05_2020.csv", MONTHS["05_2020.csv"])
    warehouse = IncrementalWarehouse(
        spark,
        str(tmp_path / "out"),
        clock=lambda: dt.datetime(2020, 5, 20),
        wanted_marts=("dm_listing_neighbourhood", "dm_host_neighbourhood"),
    )
    run_incremental(warehouse, str(source))
    for name in ("12_2020.csv", "01_2021.csv"):
        write_month(source, name, MONTHS[name])
    (source / "lga_code_2.csv").write_text("lga_code,lga_name\n11,Sydney\n12,Far\n")
    warehouse.clock = lambda: dt.datetime(2021, 1, 3)
    mart = tmp_path / "out/gold/dm_listing_neighbourhood/month_year=2020-05-01"
    before = {f.name: f.stat().st_mtime_ns for f in mart.iterdir()}
    run_incremental(warehouse, str(source))
    # months that did not change were not written again
    assert before == {f.name: f.stat().st_mtime_ns for f in mart.iterdir()}
    names = {(r.lga_code, r.lga_name, str(r.valid_from)) for r in warehouse.dim_lga().collect()}
    assert names == {
        (11, "Sydney", "1900-01-01"), (11, "Sydney", "2021-01-01"), (12, "Far", "1900-01-01"),
    }
    assert [r.lga_code for r in warehouse.dim_suburb().collect()] == [11]
    assert warehouse.census("g01").first().tot_p_p == 7
    assert warehouse.census("g02").first().median_age_persons == 35
    fact, homes, hosts = warehouse.fact(), warehouse.dim_property(), warehouse.dim_host()
    for name, whole in (
        ("dm_listing_neighbourhood", marts.dm_listing_neighbourhood(fact, homes, hosts)),
        ("dm_host_neighbourhood", marts.dm_host_neighbourhood(fact, hosts, warehouse.dim_suburb())),
    ):
        stepped = warehouse.mart(name).select(*whole.columns)
        assert sorted(map(str, stepped.collect())) == sorted(map(str, whole.collect())), name


def test_a_fact_without_its_version_stops_the_step(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    write_month(source, "05_2020.csv", MONTHS["05_2020.csv"])
    warehouse = IncrementalWarehouse(
        spark, str(tmp_path / "out"), areas(spark), wanted_marts=()
    )
    whole = warehouse.dim_property
    monkeypatch.setattr(warehouse, "dim_property", lambda: whole().filter("listing_id <> 2"))
    with pytest.raises(ValueError, match="not exactly one version.*property"):
        warehouse.process_batch(load.list_files(spark, str(source)))
    assert warehouse.finished().isEmpty()


def test_rerun_after_a_crash_repeats_nothing(spark, tmp_path, monkeypatch):
    source = tmp_path / "in"
    source.mkdir()
    write_month(source, "05_2020.csv", MONTHS["05_2020.csv"])
    warehouse = IncrementalWarehouse(
        spark, str(tmp_path / "out"), areas(spark), wanted_marts=()
    )
    monkeypatch.setattr(warehouse.properties, "apply_all", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.process_batch(load.list_files(spark, str(source)))
    monkeypatch.undo()
    assert warehouse.process_batch(load.list_files(spark, str(source))) == ["05_2020.csv"]
    assert len(warehouse.hosts.read().collect()) == 1
    assert len(facts(warehouse)) == 2


def test_files_without_line_breaks_in_cells_can_be_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text('lga_code,lga_name\n1,"a, ""b"""\n')
    (tmp_path / "b.csv").write_text('lga_code,lga_name\n1,"a\nb"\n')
    assert not has_split_cells(spark, str(tmp_path / "a.csv"))
    assert has_split_cells(spark, str(tmp_path / "b.csv"))
    both = read_raw_csv(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], AREAS)
    assert {r.lga_name for r in both.collect()} == {'a, "b"', "a\nb"}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
        a = load.write_table(rows, str(tmp_path), "gold", "a", bucket_by="id", buckets=4)
        b = load.write_table(rows, str(tmp_path), "gold", "b", bucket_by="id", buckets=4)
        joined = a.join(b.withColumnRenamed("v", "w"), "id")
        assert joined.count() == 100
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_marts_use_the_buckets_of_gold(spark, tmp_path):
    """Fact and properties in buckets within months: no shuffle of either for their join."""
    from tidemark.operators.pointintime import pit_join

    month = F.make_date(F.lit(2020), (F.col("id") % 3 + 1).cast("int"), F.lit(1))
    listing = (F.col("id") % 50).alias("listing_id")
    fact = spark.range(600).select(listing, "id", month.alias("month_date"))
    versions = [("1900-01-01", "2020-02-01", "a"), ("2020-02-01", "9999-12-31", "b")]
    dim = spark.range(40).select(F.col("id").alias("listing_id")).crossJoin(
        spark.createDataFrame(versions, "f STRING, t STRING, kind STRING")
    ).selectExpr("listing_id", "date(f) AS valid_from", "date(t) AS valid_to", "kind")
    root = str(tmp_path / "gold")
    a = load.write_table(fact, root, "gold", "f", "month_date", "listing_id", 4, "gold_f_buckets")
    b = load.write_table(dim, root, "gold", "d", None, "listing_id", 4, "gold_d_buckets")
    assert a.columns == fact.columns
    files = [p.relative_to(tmp_path) for p in tmp_path.rglob("*.parquet")]
    assert len([p for p in files if "month_date=2020-01-01" in str(p)]) <= 4

    def rows(df):
        return sorted((r.listing_id, r.id, r.month_date, r.kind or "") for r in df.collect())

    for how in ("inner", "left"):
        met = pit_join(a, b, "listing_id", how=how)
        assert met.columns == ["listing_id", "id", "month_date", "kind"]
        assert rows(met) == rows(pit_join(fact, dim, "listing_id", how=how))
        text = met._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Window" in text
        # a hot key leaves its bucket
        hot = pit_join(a, b, "listing_id", how=how, hot=[3])
        assert rows(hot) == rows(met)
        assert "Exchange hashpartitioning(_key" in hot._jdf.queryExecution().executedPlan().toString()


def test_an_unreadable_table_is_not_taken_for_an_absent_one(spark, tmp_path):
    assert read_if_present(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_if_present(spark, str(tmp_path / "bad"))


def test_loads_are_packed(spark, tmp_path):
    """Rows of a load are stored as small as those of the other tables."""
    rows = spark.createDataFrame([("a", "05_2020.csv")], "cell STRING, source_file STRING")
    load.load_files(rows, str(tmp_path / "t"))
    files = [f.name for f in (tmp_path / "t").rglob("*.parquet")]
    assert files and all(".zstd." in f for f in files)


def test_sums_per_host_and_price_share_a_shuffle(spark):
    """One shuffle for both sums without hot hosts; the same rows with them."""
    day = dt.date(2020, 5, 1)
    facts = [
        (i, i % 3, day, i % 4 > 0, 10 + i % 5, 4, i % 7, 5 * i) if i % 11 else
        (i, None, day, None, None, None, 0, 0)
        for i in range(60)
    ]
    fact = spark.createDataFrame(
        facts,
        "listing_id LONG, host_id LONG, month_date DATE, has_availability BOOLEAN, price INT, "
        "review_scores_rating INT, number_of_stays INT, estimated_revenue INT",
    ).withColumns(
        {
            "price": F.col("price").cast("decimal(10,2)"),
            "review_scores_rating": F.col("review_scores_rating").cast("decimal(5,2)"),
            "estimated_revenue": F.col("estimated_revenue").cast("decimal(13,2)"),
        }
    )
    ever = (dt.date(1900, 1, 1), dt.date(9999, 12, 31))
    homes = spark.createDataFrame(
        [(i, *ever, "ab"[i % 2]) for i in range(60)],
        "listing_id LONG, valid_from DATE, valid_to DATE, listing_neighbourhood STRING",
    )
    hosts = spark.createDataFrame(
        [(i, *ever, i == 1) for i in range(3)],
        "host_id LONG, valid_from DATE, valid_to DATE, host_is_superhost BOOLEAN",
    )
    plain, spread = (marts.dm_listing_neighbourhood(fact, homes, hosts, hot) for hot in ((), [1]))
    assert plain.count() == 2
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.collect()))
    sums = marts.dm_listing_neighbourhood(fact, homes, hosts, medians=False)
    text = sums._jdf.queryExecution().executedPlan().toString()
    by_host = [line for line in text.splitlines() if "Exchange hashpartitioning(listing_n" in line]
    assert sum("host_id" in line for line in by_host) == 1
