"""Growing log files as a stream: appended, partial, truncated, replaced, grown anew, deleted; what is read for it."""

import json
import os
import random

import pytest


from folioforge.session import new_folder, ship
from folioforge.sources import logs


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def place(spark):
    folder = new_folder(spark, "logs")
    os.makedirs(f"{folder}/in/deep")
    return folder


def put(place, name, text, mode="w"):
    with open(f"{place}/in/{name}", mode + "b") as stream:
        stream.write(text if isinstance(text, bytes) else text.encode())


def polled(spark, place, chunk=32 << 20):
    logs.append_lines(logs.lines_of(spark, f"{place}/in", "*.jsonl", chunk), f"{place}/out")
    return sorted((r.file, r.at, r.line) for r in logs.current_lines(spark, f"{place}/out").collect())


def expected(place):
    out = []
    for folder, _, names in os.walk(f"{place}/in"):
        for name in names:
            if name.endswith(".jsonl"):
                data = open(f"{folder}/{name}", "rb").read()
                at = 0
                for line in data[: data.rfind(b"\n") + 1].split(b"\n")[:-1]:
                    out.append((os.path.relpath(f"{folder}/{name}", f"{place}/in"), at, line.decode(errors="replace")))
                    at += len(line) + 1
    return sorted(out)


def test_a_log_through_its_life(spark, place):
    steps = [
        lambda: (put(place, "a.jsonl", "one\ntwo\npart"), put(place, "deep/b.jsonl", b"\xff\n\n\r\nlast\n"), put(place, "other.txt", "no\n")),
        lambda: put(place, "a.jsonl", "ial\nthree\n", "a"),
        lambda: None,
        lambda: put(place, "a.jsonl", "new\n"),  # truncated
        lambda: put(place, "a.jsonl", "grown anew\n" + "x" * 300 + "\nlonger than before\n"),
        lambda: (os.rename(f"{place}/in/a.jsonl", f"{place}/in/a.old"), put(place, "a.jsonl", "rotated\n")),
        lambda: (os.remove(f"{place}/in/deep/b.jsonl"), put(place, "a.jsonl", "and more\n", "a")),
        lambda: put(place, "a.jsonl", "never ended"),
        lambda: (put(place, "a.jsonl", "\n", "a"), put(place, "deep/b.jsonl", "back\n")),
    ]
    for k, step in enumerate(steps):
        step()
        assert polled(spark, place, chunk=(7, 32 << 20)[k % 2]) == expected(place), k


def test_an_empty_folder(spark, place):
    put(place, "a.jsonl", "")
    logs.append_lines(logs.lines_of(spark, f"{place}/in", "*.jsonl"), f"{place}/out")
    put(place, "a.jsonl", "first\n", "a")
    assert polled(spark, place) == [("a.jsonl", 0, "first")]




def test_ranges_give_every_line_once(place):
    chance = random.Random(4)
    text = "".join("x" * chance.choice([0, 1, 5, 40]) + chance.choice(["\n", "\r\n", "é\n"]) for _ in range(200))
    put(place, "a.jsonl", text)
    for chunk in (1, 3, 17, 64, 10_000):
        reader = logs.LogReader({"path": f"{place}/in", "pattern": "*.jsonl", "chunk": str(chunk)})
        parts = reader.partitions({"files": {}}, reader.latestOffset())
        rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["file"], r["at"], r["line"]) for r in rows] == expected(place)


def test_only_new_bytes_and_anchors_are_read(monkeypatch, place):
    put(place, "a.jsonl", "".join(json.dumps({"call": k}) + "\n" for k in range(5000)))
    reader = logs.LogReader({"path": f"{place}/in", "pattern": "*.jsonl"})
    first = reader.latestOffset()
    new = json.dumps({"call": "next"}) + "\n"
    put(place, "a.jsonl", new, "a")
    sizes = []
    plain = logs._read
    monkeypatch.setattr(logs, "_read", lambda files, path, at, n: sizes.append(n) or plain(files, path, at, n))
    second = reader.latestOffset()
    parts = reader.partitions(first, second)
    assert sum(p.end - p.at for p in parts) == len(new)
    assert sum(sizes) <= logs.TAIL + 4 * logs.ANCHOR
    sizes.clear()
    assert reader.latestOffset() == second and not reader.partitions(second, second) and not sizes


def test_a_repeated_batch_of_a_replaced_file_gives_nothing(place):
    put(place, "a.jsonl", "old\n")
    reader = logs.LogReader({"path": f"{place}/in", "pattern": "*.jsonl"})
    start, end = reader.initialOffset(), reader.latestOffset()
    put(place, "a.jsonl", "new content\n")
    assert [b for p in reader.partitions(start, end) for b in reader.read(p)] == []
    parts = reader.partitions(end, reader.latestOffset())
    assert [(r["line"], r["restarted"]) for p in parts for b in reader.read(p) for r in b.to_pylist()] == [(None, True), ("new content", False)]
