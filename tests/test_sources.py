"""File sources, ledgers and streams on odd input and across restarts."""

import codecs

import pytest

from folioforge.sources import files, jsonl
from folioforge.streaming import calls

SCHEMA = "id long, name string"


@pytest.mark.parametrize(
    ("data", "expected"),
    [
        ("Größe 表".encode(), ("Größe 表", "utf-8", False, None)),
        (codecs.BOM_UTF8 + b"abc", ("abc", "utf-8", True, None)),
        (codecs.BOM_UTF16_LE + "表".encode("utf-16-le"), ("表", "utf-16-le", True, None)),
        (codecs.BOM_UTF32_BE + "x表".encode("utf-32-be"), ("x表", "utf-32-be", True, None)),
        ("批号".encode("gb18030"), ("批号", "gb18030", False, None)),
        (b"a\0b", (None, "utf-8", False, "NUL character")),
        (b"\xff\xff\xff", (None, None, False, "unknown encoding")),
        (b"", ("", "utf-8", False, None)),
        (None, (None, None, False, "missing")),
    ],
)
def test_decode(data, expected):
    assert files.decode(data) == expected


def test_inventory_leaves_hidden_files_out(spark, tmp_path):
    for name in ("a.pdf", "b.PDF", "._a.pdf", "sub/c.pdf", ".hidden/d.pdf", "sub/.x/e.pdf", "f.txt"):
        path = tmp_path / "root" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    found = files.inventory(spark, str(tmp_path / "root"), ".pdf").collect()
    assert sorted((r.path, r.length) for r in found) == [("a.pdf", 5), ("b.PDF", 5), ("sub/c.pdf", 5)]


def test_ledgers_are_read_strictly_or_counted(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = [(1, "a"), (2, None), (3, "line\nbreak")]
    jsonl.write(spark.createDataFrame(rows, SCHEMA), path)
    assert sorted(map(tuple, jsonl.read_strict(spark, path, SCHEMA).collect())) == rows
    (tmp_path / "ledger" / "more.json").write_text('{"id": 4, "name": "d"}\n\n[1]\n{"id": 5, "na\n')
    good, bad = jsonl.read_counted(spark, path, SCHEMA)
    assert sorted(r.id for r in good.collect()) == [1, 2, 3, 4] and [r.malformed for r in bad.collect()] == [2]
    with pytest.raises(Exception, match="not a ledger line"):
        jsonl.read_strict(spark, path, SCHEMA).collect()


def test_streams_go_on_from_their_checkpoint(spark, tmp_path):
    table = tmp_path / "events.parquet"
    frame = lambda rows: spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    frame([(1, 7, "view", 1.0), (2, 7, "error", 2.0), (2, 7, "error", 2.0), (3, 8, "view", 0.5)]).write.mode("append").parquet(str(table))
    state = str(tmp_path / "state")

    def run():
        calls.write_snapshots(calls.call_totals(calls.event_stream(spark, str(tmp_path))), state)
        return {r.user_id: (r.calls, r.errors, r.tokens, r.last_id) for r in calls.read_snapshot(spark, state, ["user_id"]).collect()}

    assert run() == {7: (2, 1, 300, 2), 8: (1, 0, 50, 3)}
    assert run() == {7: (2, 1, 300, 2), 8: (1, 0, 50, 3)}
    frame([(2, 7, "error", 2.0), (4, 7, "view", 0.25)]).write.mode("append").parquet(str(table))
    assert run() == {7: (3, 1, 325, 4), 8: (1, 0, 50, 3)}
