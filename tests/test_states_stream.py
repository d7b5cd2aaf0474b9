import pytest
from test_frontier import ATTEMPTS, fold_in_python, random_attempts, states

from linkloom.streaming import states as S


def _state_store(stream, root, checkpoint, profile):
    return S.write_states(S.stream_states(stream, profile, "id"), root, checkpoint)


def _state_table(stream, root, checkpoint, profile):
    return S.start_states(stream, root, checkpoint, profile, "id")


@pytest.mark.parametrize("start_stream", [_state_store, _state_table])
def test_stream_of_attempts_equals_loop(spark, profile, tmp_path, start_stream):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows, want = random_attempts(n=2500, seed=21), {}
    # Batches arrive one by one; inside a batch time decides.
    for start in range(0, len(rows), 900):
        chunk = rows[start : start + 900]
        want = fold_in_python(chunk, start=want)
        spark.createDataFrame(chunk, ATTEMPTS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ATTEMPTS).parquet(source)
        start_stream(stream, root, checkpoint, profile).awaitTermination()
    assert states(S.read_states(spark, root)) == want


def test_states_are_looked_up_before_the_latest_is_taken(spark, tmp_path):
    root = str(tmp_path / "states")
    spark.createDataFrame([], S._OUTPUT).write.parquet(f"{root}/{S._BATCH}=0")
    keys = spark.createDataFrame([("u",)], "url string")
    plan = S.read_states(spark, root, 5, keys)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_state_store_over_slices_with_restarts_equals_batch(spark, profile, tmp_path):
    """Attempts arrive in time slices; each slice is one micro-batch after a restart, and URLs
    cross the slices. The kept states equal one fold of all attempts."""
    from pyspark.sql import functions as F

    from linkloom.operators.frontier import fold_attempts
    from linkloom.streaming import replay

    rows = random_attempts(n=3000, seed=5)
    attempts = spark.createDataFrame(rows, ATTEMPTS)
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        stream = spark.readStream.schema(ATTEMPTS).parquet(source)
        S.write_states(S.stream_states(stream, profile, "id"), root, checkpoint).awaitTermination()

    order = F.unix_micros(F.col("attempted_at"))
    slices = replay.replay(attempts, order, source, run, rows_per_batch=1000)
    batches = spark.read.parquet(root).filter("batch_id >= 0")
    assert slices >= 3 and batches.select("batch_id").distinct().count() >= 3
    crossing = batches.groupBy("url").agg(F.countDistinct("batch_id").alias("k")).filter("k > 1")
    assert crossing.count() > 0
    want = states(fold_attempts(attempts, profile, "id"))
    assert states(S.read_states(spark, root)) == want


def test_lookup_beyond_the_broadcast_bound_still_semi_joins(spark, tmp_path, monkeypatch):
    from linkloom.operators import lookup

    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 0)
    root = str(tmp_path / "states")
    spark.createDataFrame([], S._OUTPUT).write.parquet(f"{root}/{S._BATCH}=0")
    keys = spark.createDataFrame([("u",), ("v",)], "url string")
    plan = S.read_states(spark, root, 5, keys)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Aggregate") < plan.index("LeftSemi")
    assert "broadcast" not in plan.lower()


def test_replay_reads_the_table_the_same_few_times_at_any_number_of_slices(spark, tmp_path):
    from pyspark.sql import functions as F

    from linkloom.streaming import replay

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).selectExpr("id", "if(id < 10, null, 7 * id - 3000) AS at")
    rows = rows.mapInArrow(counted, rows.schema)
    source, seen = str(tmp_path / "source"), []

    def run():
        seen.append(spark.read.schema(rows.schema).parquet(source).count())

    slices = replay.replay(rows, F.col("at"), source, run, rows_per_batch=100)
    assert slices == len(seen) == 10
    assert seen == [109 + 99 * k for k in range(9)] + [1000]
    back = spark.read.parquet(source).orderBy("id").collect()
    assert [r["id"] for r in back] == list(range(1000)) and [r["at"] for r in back[9:11]] == [None, -2930]
    assert read.value <= 4 * 1000
