"""Delimited folders of mixed headers, rejected lines, drifting JSON."""

import gzip

import pytest
from pyspark.sql import types as T

from rivulet.sources.delimited import files_by_header, read_delimited, split_rejected
from rivulet.sources.json_lines import read_json_drifting, variant_schema

XY = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.DoubleType()), T.StructField("t", T.StringType())])


def _put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.tsv").write_text(text)
    return str(folder)


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    path = _put(tmp_path / "mixed", a="x\ty\tt\n1\t1.5\tp\n", b="t\tx\ty\nq\t2\t2.5\n", c="y\tmore\tx\tt\n3.5\t?\t3\tr\n", d="x\ty\tt\n4\t4.5\ts\n")
    with gzip.open(tmp_path / "mixed" / "e.tsv.gz", "wt") as f:
        f.write("t\ty\tx\nu\t5.5\t5\n")
    (tmp_path / "mixed" / "empty.tsv").write_text("")
    (tmp_path / "mixed" / "_SUCCESS").write_text("")
    (tmp_path / "mixed" / "below").mkdir()
    (tmp_path / "mixed" / "below" / "f.tsv").write_text("y\tx\tt\n6.5\t6\tv\n")
    assert len(files_by_header(spark, path)) == 5
    got = read_delimited(spark, path, XY)
    assert got.schema == XY
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1.5, "p"), (2, 2.5, "q"), (3, 3.5, "r"), (4, 4.5, "s"), (5, 5.5, "u"), (6, 6.5, "v")]
    assert read_delimited(spark, f"{path}/a.tsv", XY).count() == 1
    assert read_delimited(spark, f"{path}/[ad].tsv", XY).count() == 2
    _put(tmp_path / "mixed", z="x\tt\n1\tp\n")
    with pytest.raises(ValueError, match="has no column y"):
        read_delimited(spark, path, XY)


def test_folders_without_rows(spark, tmp_path):
    assert read_delimited(spark, _put(tmp_path / "none"), XY, rejects=True).columns == ["x", "y", "t", "_rejected"]
    assert read_delimited(spark, _put(tmp_path / "head", a="x\ty\tt\n"), XY).count() == 0
    with pytest.raises(FileNotFoundError):
        read_delimited(spark, str(tmp_path / "absent"), XY)


def test_rejected_lines(spark, tmp_path):
    good, bad = ["1\t1.5\ta", "2\t\tb", "\t\t.", "\t\t"], ["3\t3.5", "4\t4.5\tc\td", "x\t5.5\te", "6\tsix\tf", "99999999999\t1\tg"]
    path = _put(tmp_path / "bad", a="x\ty\tt\n" + "\n".join(good + bad[:3]) + "\n", b="y\tx\tt\n1.0\t7\th\n" + "seven\t8\ti\n")
    path = _put(tmp_path / "bad", c="x\ty\tt\n" + "\n".join(bad[3:]) + "\n")
    rows = read_delimited(spark, path, XY, rejects=True)
    assert sorted(r["_rejected"] is None for r in rows.collect()) == [False] * 6 + [True] * 4
    kept, rejected = split_rejected(rows, str(tmp_path / "split"))
    assert sorted(r.line for r in rejected.collect()) == sorted([*bad, "seven\t8\ti"])
    assert kept.schema == XY and sorted(str(tuple(r)) for r in kept.collect()) == sorted(
        str(t) for t in [(1, 1.5, "a"), (2, None, "b"), (None, None, "."), (7, 1.0, "h")]
    )
    assert read_delimited(spark, path, XY, rejects=True).select("x").count() == 10  # few columns, same rows


def test_drifting_json(spark, tmp_path):
    lines = [
        '{"a": 1, "b": "x", "n": {"p": 1}}', '{"a": 2.5, "c": null}', '{"a": "text", "n": {"p": 2, "q": [1]}}', '{"b": true}',
        "{broken", "[1, 2]", "7", "", '{"a": null, "odd \'name": 3, "both \'\\\\\\"": 4}',
    ]
    path = _put(tmp_path / "json", a="\n".join(lines) + "\n")
    fields = dict(read_json_drifting(spark, path).dtypes)
    assert fields["a"] == fields["b"] == "variant" and fields["c"] == "string" and fields["odd 'name"] == "bigint"
    rows = read_json_drifting(spark, path, {"a": "double", "b": "string"}).collect()
    assert len(rows) == len(lines)
    of = lambda **k: [r for r in rows if all(getattr(r, x) == v for x, v in k.items())]
    assert sorted(r.a for r in rows if r.a is not None) == [1.0, 2.5]
    (unfit,) = [r for r in rows if r["_unfit"] and "a" in r["_unfit"]]
    assert unfit["_unfit"] == {"a": '"text"'} and unfit.n.p == 2 and unfit.n.q == [1]
    assert sorted(r["_unfit"][""] for r in rows if r["_unfit"] and "" in r["_unfit"]) == ["", "7", "[1, 2]", "{broken"]
    assert len(of(b="x")) == 1 and len(of(b="true")) == 1
    plan = read_json_drifting(spark, path, {"a": "double"})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_drifting_json_without_objects(spark, tmp_path):
    path = _put(tmp_path / "none", a="[1]\nx\n")
    assert variant_schema(spark.read.text(path)).fields == []
    assert [r["_unfit"][""] for r in read_json_drifting(spark, path).collect()] == ["[1]", "x"]
