import json

import pytest
from fundloom.sources import files as S


def test_files_in_and_out(spark, tmp_path):
    for name, text in {"a/one.csv": "id,v\n1,x\n2,NULL\n", "a/b/two.csv": "id,v,w\n3,,9\n", "a/b/c/three.txt": "t", "z.csv": "id\n7\n"}.items():
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    root = str(tmp_path)
    assert S.select_files(spark, root, "**/*.csv") == ["a/b/two.csv", "a/one.csv", "z.csv"]
    assert S.select_files(spark, root, "a/*.csv", expected=1) == ["a/one.csv"]
    assert S.select_files(spark, root, "a/**/*.txt") == ["a/b/c/three.txt"]
    with pytest.raises(ValueError, match="expected 5"):
        S.select_files(spark, root, "**/*.csv", expected=5)
    for path in ("a/one.csv", "x_y/z__w/u_v.csv", "plain"):
        assert S.unflattened_name(S.flattened_name(path)) == path
    both = S.union_csv(spark, [f"{root}/a/one.csv", f"{root}/a/b/two.csv"], ("id", "v"))
    assert both.columns == ["id", "v", "source_file", "w"] and both.count() == 3
    with pytest.raises(ValueError, match="missing columns"):
        S.union_csv(spark, [f"{root}/a/one.csv", f"{root}/z.csv"], ("id", "v"))
    assert [tuple(r) for r in S.typed_csv(spark, f"{root}/a/one.csv", {"id": "int", "v": "string"}).collect()] == [(1, "x"), (2, None)]
    df = spark.createDataFrame([(2, "b,\"q\""), (1, None)], "id int, v string")
    S.write_one_csv(df, f"{root}/out.csv", ["id", "v"], ["id"])
    S.write_one_csv(df.repartition(3), f"{root}/again.csv", ["id", "v"], ["id"])
    assert (tmp_path / "out.csv").read_bytes() == (tmp_path / "again.csv").read_bytes() == b'id,v\n1,\n2,"b,""q"""\n'


def test_configuration(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": [1, 2]}))
    (tmp_path / "c.yml").write_text("# head\nrun: 3\nname: 'a: b'\nrate: 0.5 # part\nnested:\n  on: true\n  list:\n    - x\n    - 2\nempty:\n")
    assert S.read_json(spark, str(tmp_path / "c.json")) == {"a": [1, 2]}
    assert S.read_config(spark, str(tmp_path / "c.yml")) == {"run": 3, "name": "a: b", "rate": 0.5, "nested": {"on": True, "list": ["x", 2]}, "empty": None}
    (tmp_path / "m.csv").write_text("context,value,output\nk,a,yes\nk,*,no\n,b,yes\n")
    assert S.decision_matrix(spark, str(tmp_path / "m.csv"), {"yes", "no"}) == {"k": {"a": "yes", "*": "no"}, "": {"b": "yes"}}
    (tmp_path / "m2.csv").write_text("context,value,output\nk,a,yes\nk,a,no\n")
    with pytest.raises(ValueError, match="repeated"):
        S.decision_matrix(spark, str(tmp_path / "m2.csv"))
    with pytest.raises(ValueError, match="unknown output"):
        S.decision_matrix(spark, str(tmp_path / "m.csv"), {"yes"})


def test_loading_and_upsert(spark, tmp_path):
    folder = str(tmp_path / "db")
    dim, fact = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, 2), (1, 3)], "k int, n int")
    got = S.load_tables({"fact": fact, "dim": dim, "gone": None}, folder, ["dim", "fact", "gone"])
    assert {r["name"]: r["n_rows"] for r in got.collect()} == {"dim": 1, "fact": 2}
    with pytest.raises(ValueError, match="refused: empty"):
        S.load_tables({"dim": dim.limit(0)}, folder, ["dim"], gate=lambda t: "empty" if t["dim"].isEmpty() else None)
    assert spark.read.parquet(f"{folder}/fact").count() == 2
    S.load_tables({"dim": dim}, folder, ["dim"])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["db"] and sorted(p.name for p in (tmp_path / "db").iterdir()) == ["dim"]
    up = S.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert sorted(map(tuple, up.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_grid_rows(spark):
    grid = spark.createDataFrame([("1", "2", "10", "c"), ("1", "2", "2", " b "), ("1", "2", "3", " "), ("1", "1", "1", "a")], "page string, row string, col string, t string")
    assert {(r["row"], r["block"]) for r in S.row_blocks(grid, "page", "row", "col", "t").collect()} == {("1", "a"), ("2", "b | c")}
