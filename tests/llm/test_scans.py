from fundloom.llm import scans as S

HEAD = "Velmar Torbel Growth Fund II – Quarterly Report Q4 2021"
GOOD = "the management company completed the investment during the quarter and the committee reported internal co-investment returns"


def blocks():
    out = [(f"g{i}", "F", 3 + i, str(1 + i), f"{GOOD}\nVelmar Torbel agreed {100 + i}.5 million.") for i in range(12)]
    out += [
        ("hyphen", "F", 20, "18", "the management com-\npany completed the invest-  \nment"), ("own", "F", 20, "18", "the internal co-\ninvestment returns"),
        ("misread", "F", 20, "18", "the managcment company reportcd"), ("number", "F", 20, "18", "agreed $13O.5 million"), ("merge", "F", 20, "18", "the cornpany reported"),
        ("head", "F", 20, "18", f"{HEAD.upper()}\nthe company"), ("both", "F", 20, "18", f"18   {HEAD}\nthe company"), ("page", "F", 20, None, "the company\n18"),
        ("foot", "F", 20, "18", "(7)\nthe company"), ("figure", "F", 20, "18", "Vintage\n2014\n2015"), ("front", "F", 2, "ii", "the company\nii"), ("label", "F", 20, "l8", "the company"),
        ("null", "F", 20, None, None), ("empty", None, None, "Page 3", ""), ("head", "F", 20, "18", f"{HEAD.upper()}\nthe company"), ("long", "F", 20, "18", (GOOD + "\n") * 400),
    ]
    return out


def test_noise(spark):
    df = spark.createDataFrame([(a, b, c, d, t, t, 1) for a, b, c, d, t in blocks()], "block_id string, file_id string, physical_page int, printed_page string, original_text string, search_text string, kinds int")
    got: dict = {}
    for r in S.noise(df).collect():
        got.setdefault(r["block_id"], set()).add(r["noise_kind"])
    assert got == {
        "hyphen": {"hyphen"}, "misread": {"misread"}, "number": {"misread"}, "merge": {"misread"}, "head": {"header"}, "both": {"header", "page_number"},
        "page": {"page_number"}, "front": {"page_number"}, "label": {"page_label"}, "empty": {"page_label"},
    }
    fixed = {r["block_id"]: (r["repaired_text"], r["page_label"]) for r in S.reflowed(df).collect()}
    assert fixed["hyphen"] == ("the management company completed the investment", "18") and fixed["own"][0] == "the internal co-investment returns"
    assert fixed["misread"][0] == "the management company reported" and fixed["both"][0] == "the company" and fixed["label"][1] == "18" and fixed["null"] == ("", None)
    assert S.noise(df.limit(0)).count() == 0


def test_automaton_is_complete():
    words = ["called", "fund", "committee", "modern", "return", "clean", "m", "internal"]
    trie = S.build_trie(words)

    def one_away(a, b):
        import itertools

        forms = {a}
        alphabet = "abcdefghijklmnopqrstuvwxyz"
        for i in range(len(a) + 1):
            for k, m in itertools.product((0, 1, 2), (0, 1, 2)):
                if (k, m) == (2, 2) or i + k > len(a):
                    continue
                for mid in map("".join, itertools.product(alphabet, repeat=m)):
                    if k == 0 and m == 2 or k == 2 and m == 0:
                        continue
                    forms.add(a[:i] + mid + a[i + k:])
        return b in forms

    for w in ["callcd", "fiind", "comittee", "modem", "retum", "dean", "rn", "mternal", "zzz", "funds", "xfund"]:
        assert set(S.near(w, trie)) == {x for x in words if x != w and one_away(w, x)}, w


def test_labels_and_numbers():
    assert [S.clean_label(x) for x in ("p.18", " 9.", "6 of 6", "- iv -", "Page 97", "|35", "I9", "9o", "ii", None)] == ["18", "9", "6", "iv", "97", "135", "19", "90", "ii", None]
    assert [S.number_misread(x) for x in ("$13O.5", "2O14", "l96.9", "$B3.9", "$731.S", "Q4", "1.85x", "II", "B1", "12.5%", "S", "$1.2B", "5B", "10S")] == [True] * 5 + [False] * 9


def test_a_word_visits_the_files_of_every_word_near_it():
    import random

    random.seed(3)
    letters = "abcdr"
    words = sorted({"".join(random.choice(letters) for _ in range(random.randint(1, 7))) for _ in range(600)})
    trie = S.build_trie(words)
    for w in words[::7]:
        for c in S.near(w, trie):
            assert set(S.files_near(w)) & set(S.files_of(c)), (w, c)


PLAIN = [
    "the manager reported a higher amount in the third quarter of the year", "the house of the fund was sold in the spring after a long review", "each partner received an equal part of the gain before the close",
    "a small number of loans was written down during the winter months", "new capital was drawn from every investor at the first closing date",
]


def test_unusual_misreadings_are_found_by_their_neighbours(spark):
    import random

    random.seed(9)
    rows, truth = [(f"g{i}", "F", i, None, "\n".join(PLAIN), None) for i in range(80)], {}
    for i in range(120):
        words = random.choice(PLAIN).split()
        at = random.randrange(1, len(words) - 1)
        while len(words[at]) < 2:
            at = random.randrange(1, len(words) - 1)
        w, k = words[at], random.randrange(len(words[at]))
        words[at] = w[:k] + random.choice([c for c in "aeounrstk" if c != w[k]]) + w[k + 1:]
        truth[f"m{i}"] = (words[at], w)
        rows.append((f"m{i}", "F", i, None, " ".join(words), None))
    df = spark.createDataFrame(rows, "block_id string, file_id string, physical_page int, printed_page string, original_text string, search_text string")
    prep = S.prepared(df)
    vocab = S.vocabulary(prep)
    found = {(r["block_id"], r["word"], r["true_word"]) for r in S.misreadings(prep, vocab, S.candidates(prep, vocab)).collect()}
    right = sum((b, *x) in found for b, x in truth.items())
    assert right >= 0.9 * len(truth) and len(found) - right <= 0.05 * len(truth)
    assert {r["block_id"] for r in S.noise(df).filter("noise_kind = 'misread'").collect()} == {b for b, _, _ in found}


def test_rare_words_and_other_names_are_no_misreadings(spark):
    rows = [(f"g{i}", "F", i, None, "\n".join([*PLAIN, "Velmar Packaging agreed the price"]), None) for i in range(80)]
    rows += [("a", "F", 1, None, "the sector grew and a sectors review followed", None), ("b", "F", 1, None, "Velnar Holdings agreed the price", None), ("c", "F", 1, None, "he noted the hose was old", None)]
    df = spark.createDataFrame(rows, "block_id string, file_id string, physical_page int, printed_page string, original_text string, search_text string")
    assert S.noise(df).count() == 0


def test_every_recurring_head_is_found_and_both_texts_are_repaired(spark):
    heads = [f"Alpha {x} Opportunities Yearly Statement" for x in ("Norvel", "Sartor", "Kelmin", "Dorval", "Perlan", "Ostrel")]
    rows = [(f"{i}-{j}", "F", i, None, f"{h}\nthe manager re-\nported a gain", f"{h} the manager re- ported a gain") for j, h in enumerate(heads) for i in range(3 + j)]
    rows += [("once", "F", 1, None, "Some Other Title Line Here\nthe manager reported a gain", None)]
    df = spark.createDataFrame(rows, "block_id string, file_id string, physical_page int, printed_page string, original_text string, search_text string")
    got = {r["block_id"] for r in S.noise(df).filter("noise_kind = 'header'").collect()}
    assert got == {r[0] for r in rows} - {"once"}
    fixed = {r["block_id"]: r for r in S.reflowed(df).collect()}
    assert fixed["0-0"]["repaired_text"] == fixed["0-0"]["repaired_search_text"] == "the manager reported a gain"
