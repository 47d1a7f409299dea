"""The landed entity source: splits, missing cells, pruned fields, pushed filters."""
import json
import random

import pytest
from pyspark.sql import functions as F

from burnup.sources import landed as la

FIELDS = ["id", "ahaid", "title", "status"]


def write(path, rows, files=2, end="\n"):
    path.mkdir()
    for i in range(files):
        lines = [json.dumps({"methodValues": None if r is None else [{"elementValue": c} for c in r], "more": i}) for r in rows[i::files]]
        (path / f"part-{i}.json").write_text(end.join(lines) + (end if i else ""))
    (path / "_SUCCESS").write_text("")
    return str(path)


def some_rows(n=200):
    r = random.Random(2)
    text = lambda: r.choice(["", "None", "é" * r.randint(0, 9), 'say "x"\\ \n', None, "plain", "Active", "Closed"])
    return [[str(i), *(text() for _ in range(r.choice([3, 3, 3, 0, 1, 6])))] for i in range(n)] + [[], None]


def want(rows, names):
    return sorted(([(r or [])[FIELDS.index(n)] if FIELDS.index(n) < len(r or []) else None for n in names] for r in rows), key=str)


@pytest.mark.parametrize("split_bytes", [7, 500, 1 << 26])
def test_cells_by_place(spark, tmp_path, split_bytes):
    rows = some_rows(200 if split_bytes > 7 else 12)
    path = write(tmp_path / "in", rows)
    df = la.read_landed(spark, path, FIELDS, ["status", "id"], split_bytes=split_bytes)
    assert sorted((list(r) for r in df.collect()), key=str) == want(rows, ["status", "id"])
    assert la.read_landed(spark, "file://" + path, FIELDS).columns == FIELDS


@pytest.mark.parametrize("block", [3, 10, 1 << 20])
def test_every_line_is_in_one_split(tmp_path, monkeypatch, block):
    monkeypatch.setattr(la, "BLOCK_BYTES", block)
    r = random.Random(block)
    for end in ("", "\n"):
        lines = [b"x" * r.choice([0, 1, 2, 9, 30]) for _ in range(40)] + [b"y"]
        data = b"\n".join(lines) + end.encode()
        f = tmp_path / f"lines{len(end)}"
        f.write_bytes(data)
        for size in (1, 2, 5, 17, 1000):
            got = b"".join(x for a in range(0, len(data), size) for x in la.lines_of(la.Split(str(f), a, min(a + size, len(data)))))
            assert got == data, (size, end)


def test_fields_are_pruned_and_filters_pushed(spark, tmp_path):
    rows = some_rows()
    path = write(tmp_path / "in", rows)
    df = la.read_landed(spark, path, FIELDS, ["id", "status"])
    for condition in ("status = 'Active'", "status IN ('Active', '')", "status IS NULL", "status >= 'b' AND id < '5'", "NOT status = 'Active'", "length(status) = 4"):
        left = df.where(condition)
        plain = spark.createDataFrame([tuple(x) for x in want(rows, ["id", "status"])], "id string, status string").where(condition)
        assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str), condition
    plan = df.where("status = 'Active'")._jdf.queryExecution().executedPlan().toString()
    assert "landed_entity" in plan and "ahaid" not in plan and "title" not in plan
    reader = la.LandedReader(df.schema, {"path": path, "fields": ",".join(FIELDS)})
    assert len(list(reader.pushFilters([la.EqualTo(("status",), "Active"), la.EqualTo(("status",), 5)]))) == 2
    handed = sum(b.num_rows for s in reader.partitions() for b in reader.read(s))
    assert handed == sum(x[0] == "Active" for x in want(rows, ["status"])) > 0


def test_empty_and_wrong_input(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.json").write_text("\n\n")
    for name in ("none", "empty"):
        assert la.read_landed(spark, str(tmp_path / name), FIELDS, ["id"]).collect() == []
    with pytest.raises(Exception, match="not among the entity's fields"):
        la.read_landed(spark, str(tmp_path / "none"), FIELDS, ["other"]).collect()
    (tmp_path / "wrong").mkdir()
    (tmp_path / "wrong" / "a.json").write_text('{"methodValues": [{"elementValue": "1"}]}\nnot json\n')
    with pytest.raises(Exception, match="JSON"):
        la.read_landed(spark, str(tmp_path / "wrong"), FIELDS, ["id"]).agg(F.count("id")).collect()
