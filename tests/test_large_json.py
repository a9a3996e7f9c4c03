"""Documents cut by byte range against whole documents."""

import json
import random

import pytest

from beforeafter.sources.documents import nested_entries, nested_observations, read_documents
from beforeafter.sources.large_json import split_documents

VALUES = [
    1, 2.5, None, "x,y", 'q"u\\o"te', "br{ace}[s],", True, {"a": [1, {"b": "}"}], "c": "d,e"}, [1, "a,b", {"z": 2}], "", -3e10, "é,𝕏", "\\", "\\\\,",
]
KEYS = ["K", "Korea, Rep.", 'a"b', "c\\", "{x", "}y,", "é", " "]


def made(pick):
    def key():
        return pick.choice(KEYS) + str(pick.randint(0, 10**6))

    def value():
        return pick.choice([*VALUES, " long, " * pick.randint(1, 30)])

    def entity():
        if pick.random() < 0.2:
            return pick.choice([None, "z", {}, [{"q": 1}]])
        return {str(1990 + i): value() for i in range(pick.randint(0, 12))}

    def indicator():
        return pick.choice([7, "s,t", [1, {"a": {"b": 1}}], {}]) if pick.random() < 0.2 else {key(): entity() for _ in range(8)}

    return {
        "api": {"v": [1, {"values": {"x": {"y": {"1": 2}}}}], "n": "a,b"},
        "values": {key(): indicator() for _ in range(6)},
        "tail": ["values", {"values": 1}],
    }


@pytest.fixture
def split_size(spark):
    """Sets how many bytes of a file a task reads."""
    names = {"spark.sql.files.maxPartitionBytes": "", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        for n, v in names.items():
            spark.conf.set(n, v or size)

    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root, pick = tmp_path_factory.mktemp("documents"), random.Random(5)
    for i in range(6):
        (root / f"f{i}.json").write_text(json.dumps(made(pick), indent=pick.choice([None, 1]), ensure_ascii=i % 2 == 0))
    (root / "cut.json").write_text('{"values":{"I":{"E":{"1990":1}}')
    (root / "string.json").write_text('{"values":{"I":{"E":{"1990":1, "1991":"}}}}')
    (root / "empty.json").write_text("")
    (root / "list.json").write_text('[{"values":{"I":{"E":{"1990":1}}}}]')
    (root / "number.json").write_text("17")
    return str(root)


@pytest.mark.parametrize("size, chunk_chars", [("128m", 1 << 20), ("1k", 50), ("3k", 1)])
def test_split_documents_equal_whole_ones(spark, rows, folder, split_size, size, chunk_chars):
    want = rows(nested_entries(read_documents(spark, folder)))
    split_size(size)
    assert len(want) > 1000 and rows(nested_entries(split_documents(spark, folder, chunk_chars=chunk_chars))) == want


def test_one_document_becomes_many_tasks(spark, rows, tmp_path, split_size):
    entities = {f"E{e}": {str(1900 + t): e * t / 7 for t in range(100)} for e in range(300)}
    (tmp_path / "large.json").write_text(json.dumps({"values": {"I": entities}}))
    whole = read_documents(spark, str(tmp_path))
    want = rows(nested_observations(whole))
    split_size("64k")
    pieces = split_documents(spark, str(tmp_path), chunk_chars=1 << 14)
    assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert pieces.count() >= 300 and rows(nested_observations(pieces)) == want and len(want) == 30_000


def test_what_splitting_leaves_out_and_keeps(spark, rows, tmp_path):
    (tmp_path / "two.json").write_text('{"values":{"I":{"E":{"1":1}}}} {"values":{"I":{"E":{"2":2}}}}')
    (tmp_path / "over.json").write_text('{"values":{"J":{"E":{"1":1}}}}}')
    found = rows(nested_observations(split_documents(spark, str(tmp_path))))
    assert [r[:3] for r in found] == [("E", "I", 1), ("E", "I", 2)]
    key, long = "x, " * 1_000, "x, " * 100_000
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "long.json").write_text(json.dumps({"values": {"I": {key: {"1": 1, "2": long, "3": 3}}}}))
    got = rows(nested_entries(split_documents(spark, str(tmp_path / "deep"), chunk_chars=1000)))
    assert got == [(key, "I", "1", "1"), (key, "I", "2", long), (key, "I", "3", "3")]
