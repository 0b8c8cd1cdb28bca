import json
import os

from conftest import at, event, micros

from driftlake.sources import events, offsets

START = micros(at("10:00:00"))


def lines(spark, *seconds):
    return spark.createDataFrame([(event(did=f"d{s}", time_us=START + int(s * 1_000_000)),) for s in seconds], "value string")


def run(spark, root, drain=False, start_us=0):
    rows = events.to_raw_events(offsets.read_events_by_time(spark, str(root / "in"), start_us, drain=drain))
    rows.select("did").writeStream.format("parquet").option("path", str(root / "out")).option(
        "checkpointLocation", str(root / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    return sorted(row.did for row in spark.read.schema("did string").parquet(str(root / "out")).collect())


def test_closed_spans_are_read_once_and_in_order(spark, tmp_path):
    offsets.land_by_time(lines(spark, 0, 1, 9.9, 10, 21), str(tmp_path / "in"))
    assert run(spark, tmp_path) == ["d0", "d1", "d10", "d9.9"]
    offsets.land_by_time(lines(spark, 22, 31), str(tmp_path / "in"))
    assert run(spark, tmp_path) == ["d0", "d1", "d10", "d21", "d22", "d9.9"]
    # A line of a span that was read is late.
    offsets.land_by_time(lines(spark, 5, 32), str(tmp_path / "in"))
    assert run(spark, tmp_path, drain=True) == ["d0", "d1", "d10", "d21", "d22", "d31", "d32", "d9.9"]
    with open(tmp_path / "cp" / "offsets" / max(os.listdir(tmp_path / "cp" / "offsets"), key=lambda n: n.isdigit() and int(n))) as log:
        assert json.loads(log.read().splitlines()[-1])["time_us"] == START + 40_000_000
    assert spark.read.text(str(tmp_path / "in")).count() == 9


def test_the_same_offsets_give_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    offsets.land_by_time(lines(spark, 0, 1, 10, 20, 30), path)
    reader = offsets.LandedEventsReader({"path": path})
    first, last = reader.initialOffset(), reader.latestOffset()
    assert last["time_us"] == START + 30_000_000

    def rows(start, end):
        return sorted(
            json.loads(value)["did"]
            for part in reader.partitions(start, end) for batch in reader.read(part) for value in batch["value"].to_pylist()
        )

    assert rows(first, last) == ["d0", "d1", "d10", "d20"] and rows(last, last) == []
    offsets.land_by_time(lines(spark, 11, 12, 33), path)
    assert rows(first, last) == ["d0", "d1", "d10", "d20"]
    middle = {"time_us": START + 10_000_000, "written_ns": last["written_ns"]}
    assert rows(middle, last) == ["d10", "d20"] and rows(first, middle) == ["d0", "d1"]


def test_a_start_within_a_span_and_odd_lines(spark, tmp_path):
    path = str(tmp_path / "in")
    offsets.land_by_time(lines(spark, 0, 3, 12, 40).unionByName(spark.createDataFrame([("broken",), ("é{",)], "value string")), path)
    assert run(spark, tmp_path, start_us=START + 2_000_000) == ["d12", "d3"]
    assert spark.read.text(path).filter("span = -1").count() == 2
    assert offsets.spans(spark, path, START, START + 20_000_000).count() == 3


def test_files_are_dealt_to_tasks_by_bytes(tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "TASK_BYTES", 100)
    for span, size in ((0, 60), (10, 30), (20, 30), (30, 500), (40, 1)):
        (tmp_path / f"span={span}").mkdir()
        (tmp_path / f"span={span}" / "part-0.txt").write_bytes(b"x" * size)
    reader = offsets.LandedEventsReader({"path": str(tmp_path)})
    parts = reader.partitions({"time_us": 0, "written_ns": 0}, {"time_us": 99, "written_ns": 2**62})
    assert [[int(path.split("span=")[1].split("/")[0]) for path in part.paths] for part in parts] == [[0, 10], [20], [30], [40]]


def test_an_empty_landing_zone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    reader = offsets.LandedEventsReader({"path": str(tmp_path / "in")})
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
    (tmp_path / "in" / "span=0").mkdir()
    (tmp_path / "in" / "span=0" / "part-0.txt").write_bytes(b"a\nb" + b"x" * offsets.BLOCK_BYTES + b"\n\nlast")
    got = [v for p in reader.partitions({"time_us": 0, "written_ns": 0}, {"time_us": 1, "written_ns": 2**62}) for b in reader.read(p) for v in b["value"].to_pylist()]
    assert [len(value) for value in got] == [1, 1 + offsets.BLOCK_BYTES, 0, 4]
