from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import NOON
from tickloom.schema import TICK_COLS, key_projection, tick_projection, with_exchange_name
from tickloom.sources.tick_table import BatchConflictError, DuplicateKeyError, TickTable, duplicate_keys


@pytest.fixture
def table(spark, tmp_path):
    return TickTable(spark, str(tmp_path / "ticks")).create()


def test_create_is_repeatable(spark, table, make_ticks):
    assert table.read().count() == 0
    table.append(make_ticks([{}]), 0)
    table.create()
    assert table.read().count() == 1


def test_append_and_point_read(table, make_ticks):
    commit = table.append(make_ticks([{"source_id": i, "price": f"{i}.5"} for i in (1, 2, 3)]), 0)
    assert commit.rows == 3
    row = table.read().where("source_id = 2").select("symbol", "price", "volume", "source_id").first()
    assert (row.symbol, str(row.price), row.source_id) == ("BTCUSDT", "2.500000000000000000", 2)
    assert [c for c in table.read().columns if c in TICK_COLS] == TICK_COLS


def test_empty_batch_changes_nothing(table, make_ticks):
    assert table.append(make_ticks([{}]).limit(0), 0).rows == 0
    assert table.commits().count() == 0 and table.read().count() == 0


def test_repeat_inside_batch_fails_whole_batch(table, make_ticks):
    with pytest.raises(DuplicateKeyError):
        table.append(make_ticks([{"source_id": 1}, {"source_id": 2}, {"source_id": 1, "at": 9}]), 0)
    assert table.read().count() == 0
    # The next batch works, and so does a corrected retry under the same id.
    other_day = NOON - timedelta(days=3)
    assert table.append(make_ticks([{"source_id": 3, "exchange_ts": other_day}]), 0).rows == 1
    assert [r.source_id for r in table.read().collect()] == [3]


def test_repeat_of_stored_key_fails(table, make_ticks):
    table.append(make_ticks([{"source_id": 1}, {"source_id": 2}]), 0)
    with pytest.raises(DuplicateKeyError, match="source_id"):
        table.append(make_ticks([{"source_id": 2, "at": 600}, {"source_id": 9}]), 1)
    assert sorted(r.source_id for r in table.read().collect()) == [1, 2]
    assert table.append(make_ticks([{"source_id": 2, "symbol": "ETHUSDT"}]), 1).rows == 1


def test_committed_batch_is_not_written_twice(table, make_ticks):
    ticks = make_ticks([{"source_id": i} for i in range(4)])
    assert table.append(ticks, 0).rows == table.append(ticks, 0).rows == 4
    assert table.read().count() == 4


def test_failed_write_is_invisible_and_replaced(spark, table, make_ticks):
    boom = F.when(F.col("source_id") == 7, F.raise_error(F.lit("disk on fire")).cast("smallint"))
    broken = make_ticks([{"source_id": i} for i in range(8)])
    broken = broken.withColumn("exchange", boom.otherwise(F.col("exchange")))
    with pytest.raises(Exception, match="disk on fire"):
        table.append(broken, 0)
    assert table.read().count() == 0
    assert table.append(make_ticks([{"source_id": 1}]), 0).rows == 1


def test_ids_are_unique_across_batches_and_writers(table, make_ticks):
    for batch in range(3):
        rows = [{"source_id": batch * 500 + i} for i in range(500)]
        table.append(make_ticks(rows), batch, writers=4, max_rows_per_file=100)
    stored = table.read()
    assert stored.count() == 1500 and stored.select("batch_seq", "position").distinct().count() == 1500
    # A row's number stays in its batch's range, however old the table is.
    assert stored.agg(F.max("batch_seq")).first()[0] == 2


def test_same_id_with_other_content_is_refused(table, make_ticks):
    table.append(make_ticks([{"source_id": 1}]), 0)
    with pytest.raises(BatchConflictError):
        table.append(make_ticks([{"source_id": 2}]), 0)
    assert table.append(make_ticks([{"source_id": 2}]), 0, "other").rows == 1
    assert sorted(r.source_id for r in table.read().collect()) == [1, 2]


def test_small_batches_read_little_of_an_old_table(spark, tmp_path, make_ticks):
    """A small batch looks at the folders of its own days and of recent arrivals, before and after a compaction."""
    table = TickTable(spark, str(tmp_path / "old")).create()
    for day in range(12):
        table.append(make_ticks([{"source_id": day, "exchange_ts": NOON - timedelta(days=day), "at": day * 100}]), day)
    entries = table._entries()
    late = int((NOON + timedelta(seconds=1000)).timestamp() * 1e6)
    assert len(table.arrived_since(late, "batch", 99).inputFiles()) == 2
    assert len(table._on_days(entries, [entries[5].days[0]]).inputFiles()) == 1
    before = sorted(map(tuple, table.read().collect()))
    table.compact()
    assert sorted(map(tuple, table.read().collect())) == before
    assert len(table._log_files()) == 1 and table.commits().count() == 12
    assert {r.batch_seq for r in table.arrived_since(late, "batch", 99).collect()} == {10, 11}
    # Batches stored before are still known, and their keys are still refused.
    assert table.append(make_ticks([{"source_id": 11, "exchange_ts": NOON - timedelta(days=11), "at": 1100}]), 11).rows == 1
    with pytest.raises(DuplicateKeyError):
        table.append(make_ticks([{"source_id": 3, "exchange_ts": NOON - timedelta(days=3), "at": 5000}]), 20)
    assert table.append(make_ticks([{"source_id": 77}]), 20).rows == 1
    assert table.read().count() == 13


def test_arrival_numbers_are_stored_in_order(table, make_ticks):
    table.append(make_ticks([{"source_id": i, "at": -i} for i in range(50)]), 0, writers=1)
    stored = table.read().orderBy("position").collect()
    assert [r.arrival_seq for r in stored] == list(range(49, -1, -1))


def test_ignore_and_keep(spark, tmp_path, make_ticks):
    rows = make_ticks([{"source_id": 1, "price": "1"}, {"source_id": 1, "price": "2", "at": 61}, {"source_id": 2}])
    ignore = TickTable(spark, str(tmp_path / "i"), "ignore").create()
    assert ignore.append(rows, 0).rows == 2
    assert ignore.append(make_ticks([{"source_id": 2}, {"source_id": 3}]), 1).rows == 1
    assert sorted((r.source_id, int(r.price)) for r in ignore.read().collect()) == [(1, 1), (2, 50000), (3, 50000)]
    assert TickTable(spark, str(tmp_path / "k"), "keep").create().append(rows, 0).rows == 3
    with pytest.raises(ValueError):
        TickTable(spark, "x", "replace")


def test_offsets_are_stored_as_instants(table, make_ticks):
    local = datetime(2026, 5, 29, 15, 0, tzinfo=timezone(timedelta(hours=3)))
    table.append(make_ticks([{"source_id": 7, "exchange_ts": local}]), 0)
    ms = table.read().where("source_id = 7").select(F.unix_millis("exchange_ts")).first()[0]
    assert ms == int(NOON.timestamp() * 1000)


def test_time_range_prunes(spark, table, make_ticks, capsys):
    rows = [{"source_id": d, "exchange_ts": NOON - timedelta(days=d)} for d in range(10)]
    table.append(make_ticks(rows), 0)
    first, last = NOON - timedelta(days=4), NOON - timedelta(days=2)
    part = table.time_range(first, last)
    assert sorted(r.source_id for r in part.collect()) == [2, 3, 4]
    part.select("symbol").explain("formatted")
    plan = capsys.readouterr().out
    scan = plan[plan.index("PartitionFilters") :]
    assert "exchange_date" in scan.split("\n")[0]
    assert "GreaterThanOrEqual(exchange_ts" in scan and "ReadSchema: struct<symbol:string,exchange_ts" in scan


def test_sql_name_and_exchange_name(spark, table, make_ticks):
    table.append(make_ticks([{"exchange": e} for e in (1, 2, 3)]), 0)
    table.register("ticks")
    assert spark.sql("SELECT count(*) FROM ticks").first()[0] == 3
    names = with_exchange_name(table.read()).select("exchange_name").collect()
    assert sorted(r[0] for r in names) == ["Binance", "Coinbase", "Kraken"]


def test_projections(make_ticks):
    ticks = make_ticks([{}, {}])
    assert tick_projection(ticks).columns == TICK_COLS
    assert key_projection(ticks).columns == ["exchange", "symbol", "exchange_ts", "source_id"]
    assert [r.copies for r in duplicate_keys(ticks).collect()] == [2]


def _days(make_ticks, first, count, start=0):
    """Two ticks a day, from day `first` on."""
    rows = [{"source_id": start + 2 * d + k, "at": 86_400 * (first + d) + k, "exchange_ts": NOON + timedelta(days=first + d)} for d in range(count) for k in (0, 1)]
    return make_ticks([r | {"arrival_seq": i} for i, r in enumerate(rows)])


def test_look_back_does_not_grow_with_the_table(spark, tmp_path, make_ticks):
    opened = []
    for days in (10, 40):
        table = TickTable(spark, str(tmp_path / f"t{days}")).create()
        table.append(_days(make_ticks, 0, days - 1), 0)
        table.append(_days(make_ticks, days - 1, 1, 1000), 1)
        table.compact()
        since = int((NOON + timedelta(days=days - 1)).timestamp() * 1e6)
        carried = table.carried_keys(since, "batch", 2)
        assert sorted(r.source_id for r in carried.collect()) == [1000, 1001]
        scan = carried._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        opened.append(scan.selectedPartitions().totalNumberOfFiles())
    assert opened == [1, 1]


def test_look_back_beyond_what_is_kept_reads_the_data(spark, tmp_path, make_ticks):
    table = TickTable(spark, str(tmp_path / "t")).create()
    for batch, first in enumerate((0, 15, 30)):
        table.append(_days(make_ticks, first, 15, 100 * batch), batch)
    for step in range(2):
        for day in (0, 20, 30, 36, 44):
            since = int((NOON + timedelta(days=day)).timestamp() * 1e6)
            carried = {(r.source_id, r.ingest_ts) for r in table.carried_keys(since, "batch", 9).collect()}
            assert carried == {(r.source_id, r.ingest_ts) for r in table.arrived_since(since, "batch", 9).collect()}
            assert len(carried) == 2 * (45 - day)
        # Keys of batches that come after one that runs again are not its business.
        since = int(NOON.timestamp() * 1e6)
        assert table.carried_keys(since, "batch", 1).count() == table.arrived_since(since, "batch", 1).count() == 30
        table.compact()
