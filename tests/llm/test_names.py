import itertools
import random

import pytest
from fundloom.llm import names as N


def plain_distance(a, b):
    """Unrestricted Damerau-Levenshtein by shortest path over strings would be slow; the textbook recursion with memory."""
    from functools import lru_cache

    @lru_cache(None)
    def d(i, j):
        if not i or not j:
            return i + j
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        for k, q in itertools.product(range(i - 1), range(j - 1)):
            if a[k] == b[j - 1] and a[i - 1] == b[q]:
                best = min(best, d(k, q) + (i - k - 2) + 1 + (j - q - 2))
        return best

    return d(len(a), len(b))


def test_distances_agree():
    random.seed(2)
    words = ["".join(random.choice("abc") for _ in range(random.randint(0, 7))) for _ in range(40)]
    codes, lengths = N.encode(words)
    for p in words:
        want = [plain_distance(p, w) for w in words]
        assert N.distances(p, codes, lengths).tolist() == want
        assert [N.distance(p, w) for w in words] == want


def test_names_within_the_radius_meet_under_a_segment():
    random.seed(4)
    for _ in range(1500):
        a = "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 18)))
        b = list(a)
        for _ in range(2):
            i = random.randrange(max(1, len(b) - 1))
            op = random.randrange(4)
            if op == 0:
                b[i: i + 1] = "z"
            elif op == 1:
                del b[i: i + 1]
            elif op == 2:
                b.insert(i, "q")
            else:
                b[i: i + 2] = b[i: i + 2][::-1]
        b = "".join(b)
        if N.distance(a, b) <= 2:
            short, longer = sorted((a, b), key=len)
            assert set(N.held_keys(short, 2)) & set(N.asking_keys(longer, 2)), (a, b)


@pytest.mark.parametrize(("cell", "chunk"), [(10, 4_096), (3, 8), (256, 4_096)])
def test_radius_join_against_all_pairs(spark, cell, chunk):
    random.seed(6)
    base = ["".join(random.choice(["kal", "ver", "mon", "tir", "sel"]) for _ in range(4)) for _ in range(40)]
    near = [b[:3] + random.choice("xyz") + b[4:] for b in base] + [b[:5] + b[6:] for b in base] + [b[:1] + b[2] + b[1] + b[3:] for b in base]
    short = ["abc", "abd", "abcd", "abce", "abcdef", "abcxyf", "abxdef", ""]
    cores = sorted({*base, *near, *short})
    df = spark.createDataFrame([("m", c) for c in cores] + [("other", base[0])], "block string, core string")
    got = {(r["a"], r["b"]) for r in N.radius_join(df, cell=cell, chunk=chunk).filter("block = 'm'").collect()}
    assert got == {(a, b) for a, b in itertools.combinations(cores, 2) if N.distance(a, b) <= N.allowed(a, b)}
    assert ("abcd", "abce") in got and ("abc", "abd") not in got and ("abcdef", "abcxyf") not in got


def test_cells_lose_no_pair():
    random.seed(8)
    names = sorted({"".join(random.choice("abc") for _ in range(random.randint(7, 11))) for _ in range(300)})
    want = {(a, b) for a, b in itertools.combinations(names, 2) if N.distance(a, b, 2) <= 2}
    assert set(N.close_pairs(names, names, 2, cell=20)) == want


def test_reordered_parts_and_typos_in_closed_parts(spark):
    rows = ["ABC Fund II", "ABC Fnud II", "ABC Fund III", "Blue Harbor Capital", "Harbor Blue Capital", "Harbor, Blue Cap.", "Bob Smith", "Robert Smith", "William Smith", "Grant Capital", "Green Harbor Capital"]
    df = spark.createDataFrame([("manager", r) for r in rows], "name_domain string, name string")
    pairs = {(r["name_a"], r["name_b"]) for r in N.variants(N.classes(df)).collect()}
    assert pairs == {
        ("ABC Fnud II", "ABC Fund II"), ("Blue Harbor Capital", "Harbor Blue Capital"), ("Blue Harbor Capital", "Harbor, Blue Cap."), ("Harbor Blue Capital", "Harbor, Blue Cap."), ("Bob Smith", "Robert Smith"),
    }


def test_reading_and_classes(spark):
    rows = [
        ("manager", "Charles Falnartor-Kirnordel Real Estate Advisors"), ("manager", "Chuck Falnartor Kirnordel Rl. Est. Advisers"), ("manager", "Falnartor-Kirnordel, Charles (Rl. Est. Advs.)"),
        ("manager", "Edward Falnartor-Kirnordel Real Estate Advisors"), ("manager", "Ralorlu & Gordradra Growth Equity"), ("manager", "Gordradra and Ralorlu Gr. Equity"),
        ("target", "Zannor Velbor Growth Fund II, L.P."), ("target", "ZANNOR  VELBOR GROWTH FD 2"), ("target", "Zannor Velbor Growth Fund III, L.P."), ("target", "Zannro Velbor Growth Fund II"),
        ("manager", "Ted Vanmar-Ordel Ventures"), ("manager", "Theodore Vanmar-Ordel Ventures"), ("manager", "Ted Kelbor-Sindra Ventures"), ("manager", "Edward Kelbor-Sindra Ventures"),
        ("manager", "Ted Alone-Family Ventures"), ("manager", "TED ALONE-FAMILY VENTURES"), ("target", None), ("target", "  "), ("target", "Fund II"), ("target", "Zannor Velbor Growth Fund II, L.P."),
    ]
    df = spark.createDataFrame(rows, "name_domain string, name string")
    classed = N.classes(df)
    pairs = {(r["name_a"], r["name_b"]) for r in N.variants(classed).collect()}
    assert len(pairs) == 3 + 1 + 3 + 3
    assert ("Ted Vanmar-Ordel Ventures", "Theodore Vanmar-Ordel Ventures") in pairs
    assert not any("Edward Fal" in a + b or "III" in a + b for a, b in pairs)
    assert N.classes(df.limit(0)).count() == 0
