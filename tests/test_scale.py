"""Work that is done once and not per reader, and joins that move few rows."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import routing
from tickloom.operators.batching import write_batches
from tickloom.operators.dedup import drop_recently_admitted, refused_rows, sliding_window_dedup
from tickloom.operators.routing import with_shard, with_shard_per_symbol
from tickloom.plans import event_feed, queries
from tickloom.sources.tick_table import TickTable


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.fixture
def some_events(spark, tmp_path):
    rows = spark.range(60).selectExpr(
        "id AS event_id", "timestampadd(SECOND, id * 7, TIMESTAMP_NTZ'2024-01-05 00:00:00') AS ts", "id % 5 AS user_id",
        "element_at(array('click', 'view', 'error'), CAST(id % 3 + 1 AS INT)) AS event_type", "id + 0.25D AS value",
        "concat('{\"k\": ', id % 60, '}') AS props",
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


@pytest.fixture
def several(make_ticks):
    return make_ticks([{"symbol": "ABC"[i % 3], "source_id": i // 2, "at": i % 50} for i in range(300)])


def test_the_hash_of_a_symbol_runs_once(several, monkeypatch, capsys):
    joined = with_shard_per_symbol(several, 4)
    assert joined.columns == with_shard(several, 4).columns
    assert joined.exceptAll(with_shard(several, 4)).isEmpty() and joined.count() == several.count()
    plan = plan_of(write_batches(several, 4, 3, timedelta(seconds=10)), capsys)
    assert "aggregate(" not in plan.replace("HashAggregate(", "").split("BroadcastExchange")[0]
    assert "BroadcastExchange" in plan
    # More symbols than a broadcast may hold are hashed in place.
    monkeypatch.setattr(routing, "BROADCAST_ROWS", 2)
    placed = with_shard_per_symbol(several, 4)
    assert "Join" not in plan_of(placed, capsys)
    assert placed.exceptAll(joined).isEmpty()


@pytest.mark.parametrize("symbol", ["", None])
def test_a_missing_symbol_has_no_shard(spark, symbol):
    bad = spark.createDataFrame([(symbol, 1)], "symbol string, n int")
    with pytest.raises(Exception, match="cannot place an empty symbol"):
        with_shard_per_symbol(bad, 4).collect()


@pytest.mark.parametrize("name", ["write_batches_aligned", "conservation_by_source"])
def test_messages_are_parsed_once(spark, some_events, monkeypatch, name):
    """The dedup reads its input several times, so it gets stored ticks and no messages."""
    given = []

    def dedup(rows, *args, **kwargs):
        given.append(rows.inputFiles())
        return sliding_window_dedup(rows, *args, **kwargs)

    monkeypatch.setattr(queries, "sliding_window_dedup", dedup)
    assert queries.all_queries()[name](spark, some_events).count() > 0
    assert given and given[0] and not any("events.parquet" in f for files in given for f in files)


def test_no_join_without_earlier_batches(spark, tmp_path, several, capsys):
    table = TickTable(spark, str(tmp_path / "ticks"), "keep").create()
    none = table.carried_keys(0, "batch", 0)
    assert none.count() == 0 and none.schema["ingest_ts"].dataType == several.schema["ingest_ts"].dataType
    assert "Join" not in plan_of(drop_recently_admitted(several, none, timedelta(seconds=5)), capsys)
    admitted = sliding_window_dedup(several, timedelta(seconds=5))
    refused = refused_rows(several, admitted, none, timedelta(seconds=5))
    assert refused.count() + admitted.count() == several.count()


def test_few_earlier_admissions_go_to_the_rows(several, capsys):
    window, earlier = timedelta(seconds=5), several.limit(3)
    left = drop_recently_admitted(several, earlier, window, count=3)
    assert "BroadcastHashJoin" in plan_of(left, capsys)
    assert left.exceptAll(drop_recently_admitted(several, earlier, window)).isEmpty()
    refused = refused_rows(several, several.limit(0), earlier, window, count=3)
    assert refused.exceptAll(refused_rows(several, several.limit(0), earlier, window)).isEmpty()


def test_keys_are_sorted_by_their_hash(several, capsys):
    plan = plan_of(sliding_window_dedup(several, timedelta(minutes=5)), capsys)
    assert "hashpartitioning(_h#" in plan and "WindowGroupLimit [_h#" in plan


def test_cuts_render_no_messages(spark, some_events, capsys):
    arrivals = event_feed.event_arrivals(event_feed.load(spark, some_events, "events"))
    assert "encode" not in plan_of(arrivals, capsys).lower()
    frames = queries._frames(spark, some_events)
    assert arrivals.exceptAll(frames.select("ingest_ts")).isEmpty() and arrivals.count() == frames.count()
    (cut,) = queries._cuts(spark, some_events, 2)
    assert 0 < frames.where(F.col("ingest_ts") < cut).count() < frames.count()
