import random

from fundloom.operators import hierarchy


def rows(df):
    return {(r["hierarchy"], r["node"]): (r["root"], r["depth"]) for r in df.collect()}


def brute(parents):
    out = {}
    for n in parents:
        seen, at, steps = [], n, 0
        while at not in seen and parents.get(at) in parents:
            seen.append(at)
            at, steps = parents[at], steps + 1
        out[n] = ("CYCLE", -1) if parents.get(at) in parents else (at, steps)
    return out


def test_against_brute_force(spark):
    random.seed(3)
    parents = {f"n{i}": random.choice([None, "", "gone", f"n{random.randrange(60)}", f"n{max(0, i - 1)}"]) for i in range(60)}
    parents |= {f"c{i}": f"c{i - 1}" for i in range(1, 70)} | {"c0": None}
    df = spark.createDataFrame([(k, v, "x") for k, v in parents.items()], "id string, up string, node string")
    links = hierarchy.links(df, "h", "id", "up")
    clean = {k: (v if v and v.strip() else None) for k, v in parents.items()}
    want = {("h", k): v for k, v in brute(clean).items()}
    assert rows(hierarchy.resolve(links)) == want
    assert rows(hierarchy.resolve(links, with_path=False, share=0.05, least=3)) == want  # hot parents take the broadcast branch


def test_paths_and_descendants(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "y"), ("s", "s")], "id string, up string")
    whole = hierarchy.resolve(hierarchy.links(df, "h", "id", "up"))
    got = {r["node"]: (r["path"], r["root"], r["depth"]) for r in whole.collect()}
    assert got["c"] == (["a", "b", "c"], "a", 2)
    assert all(got[n] == (None, "CYCLE", -1) for n in "xyzs")
    below = {(r["ancestor"], r["descendant"], r["distance"]) for r in hierarchy.descendants(whole).collect()}
    assert below == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}


def test_repeats_nulls_and_empty(spark):
    schema = "id string, up string"
    df = spark.createDataFrame([("a", "q"), ("a", "b"), ("a", "b"), ("b", " "), (None, "a"), ("", "a")], schema)
    assert rows(hierarchy.resolve(hierarchy.links(df, "h", "id", "up"))) == {("h", "a"): ("b", 1), ("h", "b"): ("b", 0)}
    assert rows(hierarchy.resolve(hierarchy.links(spark.createDataFrame([], schema), "h", "id", "up"))) == {}
    both = hierarchy.links(spark.createDataFrame([("k", "p")], schema), "h", "id", "up", parents_are_nodes=True)
    assert rows(hierarchy.resolve(both)) == {("h", "k"): ("p", 1), ("h", "p"): ("p", 0)}


def test_lineage_on_and_below_cycles(spark):
    random.seed(5)
    parents = {"a": None, "b": "a", "c": "b", "s": "s", "t": "s", "u": "t"}
    parents |= {f"r{i}": f"r{(i + 1) % 37}" for i in range(37)}  # longer than any chain without a cycle
    parents |= {f"w{i}": f"w{i - 1}" for i in range(1, 21)} | {"w0": "r5"}
    parents |= {f"n{i}": f"n{random.randrange(40)}" for i in range(40)}
    links = hierarchy.links(spark.createDataFrame(list(parents.items()), "id string, up string"), "h", "id", "up")
    want = set()
    for n in parents:
        seen, at = [n], parents[n]
        while at and at not in seen:
            want.add((at, n, len(seen)))
            seen.append(at)
            at = parents[at]
    for least in (50_000, 3):  # hot parents take the broadcast branch
        whole = hierarchy.resolve(links, share=0.05, least=least, with_walk=True)
        got = [(r["ancestor"], r["descendant"], r["distance"]) for r in hierarchy.lineage(whole).collect()]
        assert sorted(got) == sorted(want)


def test_other_parents_are_listed(spark):
    from fundloom.operators import hierarchy as H

    df = spark.createDataFrame([("n", "a"), ("n", "b"), ("n", "b"), ("n", " "), ("m", "a"), (None, "a"), ("m", None)], "id string, up string")
    assert [tuple(r) for r in H.other_parents(df, "h", "id", "up").collect()] == [("h", "n", "a", "b")]


def test_components_with_a_hub(spark, monkeypatch):
    from fundloom.operators import components as C

    links = [("hub", f"x{i}") for i in range(300)] + [("a", "b"), ("b", "c"), ("c", "c"), ("d", None)]
    df = spark.createDataFrame(links, "a string, b string")
    monkeypatch.setattr(C, "hot_keys", lambda df, keys: [("hub",)])
    got = {r["node"]: r["label"] for r in C.components(df).collect()}
    assert len({got[f"x{i}"] for i in range(300)} | {got["hub"]}) == 1 and got["a"] == got["b"] == got["c"] == "a" and "d" not in got
