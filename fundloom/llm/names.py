"""Variant spellings of the names of persons, firms and funds.

A name is read into parts: what kind of firm or fund it is (descriptor words,
abbreviations expanded, legal form), a series number, a person's first name
(nicknames resolved) and the family core - the distinctive letters, in the order
typed and in the order of its words. A short word that is one edit from a
descriptor is read both ways. Series and person are vetoes: names that differ in
them are never linked. The other parts of two spellings may differ by edits.

Cores are linked by an exact radius join in a metric space: the unrestricted
Damerau-Levenshtein distance, a true metric. Names meet under the segments that
edits leave intact (pigeonhole), and each such group is partitioned by pivots
drawn from it: a name belongs to the cell of its nearest pivot, and names that
look for partners go to every cell they could have one in - by the triangle
inequality those whose pivot is no farther than the cell's own extent plus the
radius. Each cell is joined exactly. A group too large for a task is cut into
blocks on both sides, whatever its size.

Short cores have a smaller radius: an edit in four letters makes another name.

Defined results: null and blank names are no names; repeated names count once;
a name without distinctive letters is linked to nothing; a short form of
several first names stands for the one that its family spells out; classes are the
connected components of the links.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.functions.frames import frame
from fundloom.operators.components import components
from fundloom.session import spread, written

# Descriptor words with their usual abbreviations.
ABBREVIATED = {
    "equity": ["eq", "eqty"], "advisors": ["advs", "advisers", "advisor", "adviser", "advrs"], "growth": ["gr", "grth"],
    "management": ["mgmt", "mgt", "mgmnt"], "capital": ["cap"], "partners": ["ptnrs", "prtnrs", "ptrs", "partner"], "ventures": ["vent", "vents"],
    "estate": ["est"], "investment": ["inv", "invt", "invest", "investments"], "asset": ["ast", "asst"], "assets": ["asts"], "real": ["rl"],
    "credit": ["cr", "crdt", "cred"], "group": ["grp"], "private": ["pvt", "priv"], "infrastructure": ["infra", "infrastr"],
    "fund": ["fd"], "services": ["svcs", "svc", "serv", "service"], "holdings": ["hldgs", "hldg", "holding"], "international": ["intl", "int", "internatl"],
    "corporation": ["corp"], "limited": ["ltd"], "company": ["co"], "energy": ["engy", "en"], "packaging": ["pkg", "pkging", "packg"],
    "logistics": ["log", "logs"], "software": ["sw", "sftw"], "secondaries": ["sec", "secs", "second"], "opportunities": ["opp", "opps"],
    "industrial": ["indl", "ind", "indust"], "foods": ["fds"], "materials": ["matls", "mat", "mats"], "buyout": ["bo", "buyt"], "health": ["hlth"],
    "technologies": ["tech", "techs", "technology"], "insurance": ["ins", "insur"], "education": ["edu", "educ"], "communications": ["comms", "comm"],
    "lp": [], "llc": [], "inc": ["incorporated"], "gmbh": [], "bv": [], "sa": [], "and": [],
}
LEGAL = {"lp", "llc", "inc", "limited", "corporation", "gmbh", "bv", "sa", "company", "holdings", "group", "international", "and"}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10, "xi": 11, "xii": 12, "xiii": 13, "xiv": 14, "xv": 15}
# First names with their usual short forms.
NICKNAMES = {
    "alexander": ["alex", "sandy", "alec", "xander"], "alexandra": ["alex", "sandy"], "sandra": ["sandy"], "andrew": ["andy", "drew"], "anthony": ["tony"], "barbara": ["barb"], "benjamin": ["ben"],
    "catherine": ["cathy", "cate"], "charles": ["charlie", "chuck", "chas"], "christopher": ["chris", "kit"], "christine": ["chris", "chrissy"], "daniel": ["dan", "danny"], "david": ["dave", "davy"],
    "deborah": ["deb", "debbie"], "dorothy": ["dot", "dottie"], "edward": ["ed", "ted", "eddie", "ned"], "elizabeth": ["beth", "liz", "betty", "eliza", "lizzie", "betsy"],
    "francis": ["frank"], "frederick": ["fred", "freddie"], "gregory": ["greg"], "henry": ["harry", "hank"], "james": ["jim", "jimmy", "jamie"],
    "jennifer": ["jen", "jenny"], "john": ["jack", "johnny"], "jonathan": ["jon"], "joseph": ["joe", "joey"], "joshua": ["josh"],
    "katherine": ["kate", "kathy", "katie", "kat", "kitty"], "kenneth": ["ken", "kenny"], "lawrence": ["larry", "laurie"], "margaret": ["maggie", "peggy", "meg", "marge", "greta"],
    "matthew": ["matt"], "michael": ["mike", "mick", "mickey"], "nancy": ["nan"], "nicholas": ["nick"], "pamela": ["pam"], "patricia": ["pat", "trish", "patty", "tricia"],
    "patrick": ["pat", "paddy"], "peter": ["pete"], "philip": ["phil"], "raymond": ["ray"], "rebecca": ["becky", "becca"], "richard": ["rick", "dick", "rich", "richie"],
    "robert": ["bob", "rob", "bobby", "robbie", "bert"], "albert": ["bert", "al"], "ronald": ["ron"], "samuel": ["sam"], "samantha": ["sam"], "stephen": ["steve"], "steven": ["steve"], "susan": ["sue", "susie", "suzy"],
    "theodore": ["theo", "ted", "teddy"], "thomas": ["tom", "tommy"], "timothy": ["tim"], "victoria": ["vicky", "tori"], "vincent": ["vince"], "walter": ["walt"], "william": ["will", "bill", "billy", "willy", "liam"],
}
_WORD_OF = {a: w for w, spelled in ABBREVIATED.items() for a in [w, *spelled]}
#: The first names that a name may stand for; some short forms stand for several.
_FIRSTS_OF: dict[str, list[str]] = {}
for _first, _short in NICKNAMES.items():
    for _n in [_first, *_short]:
        _FIRSTS_OF.setdefault(_n, []).append(_first)


@dataclass(frozen=True)
class Parts:
    """A name read into its parts; ``core`` holds the distinctive letters in the order typed, ``ordered`` word by word in order."""

    core: str
    kind: str
    form: str
    series: str
    persons: tuple[str, ...]
    ordered: str


def _near(a: str, b: str) -> bool:
    """Whether one edit or swap apart at most."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:] or (a[i: i + 2] == b[i: i + 2][::-1] and a[i + 2:] == b[i + 2:])


@functools.lru_cache(maxsize=100_000)
def _descriptor(word: str) -> tuple[str | None, str | None]:
    """(the descriptor that a word surely is, the one it may be if misspelled)."""
    known = _WORD_OF.get(word)
    if known or len(word) < 4:
        return known, None
    near = sorted(d for d in ABBREVIATED if len(d) >= 4 and _near(word, d))
    sure = next((d for d in near if len(d) >= 6 and len(word) >= 5), None)
    return sure, None if sure or not near else near[0]


@functools.lru_cache(maxsize=100_000)
def _firsts(word: str) -> tuple[str, ...]:
    """The first names that a word may stand for, long ones also if misspelled."""
    known = _FIRSTS_OF.get(word)
    if known is None and len(word) >= 6:
        known = next(([f] for f in NICKNAMES if len(f) >= 6 and _near(word, f)), None)
    return tuple(known or ())


def read(name: str) -> Parts | None:
    """The parts of a name at its face, or None when nothing distinctive is in it."""
    found = readings(name)
    return found[0] if found else None


def readings(name: str) -> list[Parts]:
    """The ways to read a name: at its face and, if a short word may be a misspelled descriptor, with that."""
    s = unicodedata.normalize("NFKC", name).casefold()
    s = re.sub(r"[.'’]", "", s)
    s = re.sub(r"[&+]|\band\b", " ", s)
    words = re.findall(r"[^\W_]+", s)
    out = []
    for corrected in (False, True):
        kind, form, series, persons, core = [], [], "", (), []
        left = 0
        for w in words:
            sure, maybe = _descriptor(w)
            known = sure or (maybe if corrected else None)
            left += not (known or w in ROMAN or w.isdigit())
        for w in words:
            if w in ROMAN or w.isdigit():
                series = str(ROMAN.get(w, w))
                continue
            sure, maybe = _descriptor(w)
            known = sure or (maybe if corrected else None)
            if known:
                (form if known in LEGAL else kind).append(known)
                continue
            first = _firsts(w)
            if first and left > 1 and not persons:  # something distinctive stays
                persons = first
                continue
            core.append(w)
        if core:
            parts = Parts("".join(core), " ".join(sorted(set(kind))), " ".join(sorted(set(form))), series, persons or ("",), "".join(sorted(core)))
            if parts not in out:
                out.append(parts)
    return out


def distance(a: str, b: str, limit: int | None = None) -> int:
    """Unrestricted Damerau-Levenshtein distance, a true metric; above ``limit`` some number above it."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if limit is not None and abs(n - m) > limit:
        return limit + 1
    inf = n + m
    last: dict[str, int] = {}
    d = [[inf] * (m + 2) for _ in range(n + 2)]
    for i in range(n + 1):
        d[i + 1][1] = i
    for j in range(m + 1):
        d[1][j + 1] = j
    for i in range(1, n + 1):
        match_at, best = 0, inf
        for j in range(1, m + 1):
            k, q = last.get(b[j - 1], 0), match_at
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost, match_at = 0, j
            v = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][q] + (i - k - 1) + 1 + (j - q - 1))
            d[i + 1][j + 1] = v
            best = min(best, v)
        last[a[i - 1]] = i
        if limit is not None and best > limit and i > 1 and min(d[i][1:]) > limit:
            return limit + 1
    return d[n + 1][m + 1]


# ------------------------------------------------------------ the metric join

RADIUS = 2
#: Names per cell aimed at, and rows of a group on one side that one task takes at once.
CELL, CHUNK = 256, 4_096
#: Least lengths of cores that may differ by one edit and by two.
ONE_EDIT, TWO_EDITS = 4, 7


def allowed(a: str, b: str, radius: int = RADIUS) -> int:
    """Edits by which two cores may differ: fewer for short ones."""
    n = min(len(a), len(b))
    return min(radius, 0 if n < ONE_EDIT else 1 if n < TWO_EDITS else radius)


def encode(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names as a matrix of character codes and their lengths."""
    lengths = np.array([len(n) for n in names], dtype=np.int32)
    codes = np.zeros((len(names), max(1, lengths.max(initial=0))), dtype=np.int32)
    for i, n in enumerate(names):
        codes[i, : len(n)] = [ord(c) for c in n]
    return codes, lengths


def distances(pivot: str, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """:func:`distance` of ``pivot`` to every encoded name at once."""
    n, width = codes.shape
    far = len(pivot) + width + 1
    d = np.full((len(pivot) + 2, width + 2, n), far, dtype=np.int32)
    d[1:, 1] = np.arange(len(pivot) + 1)[:, None]
    d[1, 1:] = np.arange(width + 1)[:, None]
    last: dict[int, int] = {}
    rows = np.arange(n)
    for i, char in enumerate(map(ord, pivot), 1):
        match_at = np.zeros(n, dtype=np.int32)
        for j in range(1, width + 1):
            column = codes[:, j - 1]
            same = column == char
            k = np.zeros(n, dtype=np.int32)
            for c, at in last.items():
                k[column == c] = at
            swap = d[k, match_at, rows] + (i - k - 1) + 1 + (j - match_at - 1)
            d[i + 1, j + 1] = np.minimum(np.minimum(d[i, j] + ~same, np.minimum(d[i + 1, j], d[i, j + 1]) + 1), swap)
            match_at = np.where(same, j, match_at).astype(np.int32)
        last[char] = i
    return d[len(pivot) + 1, lengths + 1, rows]


def _letter_counts(names: list[str], alphabet: dict[str, int]) -> np.ndarray:
    counts = np.zeros((len(names), len(alphabet)), dtype=np.int16)
    for i, n in enumerate(names):
        for c in n:
            counts[i, alphabet[c]] += 1
    return counts


def _in_cell(held: list[str], asking: list[str], radius: int) -> set[tuple[str, str]]:
    """Pairs (smaller, larger) of a held and an asking name within the radius, exactly.

    Letter counts bound the distance from below (an edit changes at most one
    letter on each side, a swap none), so only pairs that pass are measured.
    """
    alphabet = {c: i for i, c in enumerate(sorted({c for n in [*held, *asking] for c in n}))}
    h, out = _letter_counts(held, alphabet), set()
    for a, counts in zip(asking, _letter_counts(asking, alphabet), strict=True):
        diff = h - counts
        near = np.maximum(np.maximum(diff, 0).sum(axis=1), np.maximum(-diff, 0).sum(axis=1)) <= radius
        out |= {(min(a, held[i]), max(a, held[i])) for i in np.flatnonzero(near) if held[i] != a and _close(min(a, held[i]), max(a, held[i]), radius)}
    return out


@functools.lru_cache(maxsize=100_000)
def _letters(name: str) -> int:
    """The set of a name's letters as bits; an edit changes two of them at most."""
    out = 0
    for c in name:
        out |= 1 << (ord(c) & 63)
    return out


@functools.lru_cache(maxsize=200_000)
def _close(a: str, b: str, radius: int) -> bool:
    return distance(a, b, radius) <= allowed(a, b, radius)


def close_pairs(held: list[str], asking: list[str], radius: int, cell: int = CELL) -> list[tuple[str, str]]:
    """Pairs of a held and an asking name within the radius, joined in the cells of pivots drawn from the held ones."""
    if len(held) * len(asking) <= 4 * cell:  # one cell, few pairs
        return sorted({(min(a, b), max(a, b)) for a in asking for b in held if a != b and (_letters(a) ^ _letters(b)).bit_count() <= 2 * radius and _close(min(a, b), max(a, b), radius)})
    if len(held) <= cell:
        return sorted(_in_cell(held, asking, radius))
    pivots = held[:: cell]  # held names come in order of a hash
    codes, lengths = encode(held)
    away = np.stack([distances(p, codes, lengths) for p in pivots], axis=1)
    home = away.argmin(axis=1)
    asked_codes, asked_lengths = encode(asking)
    out: set[tuple[str, str]] = set()
    for c, p in enumerate(pivots):
        inside = np.flatnonzero(home == c)
        if len(inside):
            reach = distances(p, asked_codes, asked_lengths) <= away[inside, c].max() + radius
            out |= _in_cell([held[i] for i in inside], [asking[i] for i in np.flatnonzero(reach)], radius)
    return sorted(out)


def _segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of a name of that length; the longer ones come last."""
    short, longer = divmod(length, parts)
    cuts = [0]
    for k in range(parts):
        cuts.append(cuts[-1] + short + (k >= parts - longer))
    return list(zip(cuts, cuts[1:], strict=False))


def held_keys(name: str, radius: int) -> list[str]:
    """The segments of a name, of which one is intact in every name within the radius.

    An edit touches one segment and a swap two, as two plain edits do: so names
    within r are within 2 r plain edits, and of 2 r + 1 segments one survives.
    """
    return [f"{len(name)}:{k}:{name[a:b]}" for k, (a, b) in enumerate(_segments(len(name), 2 * radius + 1))]


def asking_keys(name: str, radius: int) -> list[str]:
    """The keys under which a name meets all held names within the radius that are no longer than it.

    A surviving segment is displaced by no more than the edits before it and no
    more than those behind it leave for the difference in length.
    """
    edits, n, keys = 2 * radius, len(name), set()
    for length in range(max(0, n - radius), n + 1):
        more = n - length
        for k, (a, b) in enumerate(_segments(length, edits + 1)):
            low = max(0, a - k, a + more - (edits - k))
            high = min(n - (b - a), a + k, a + more + (edits - k))
            keys |= {f"{length}:{k}:{name[x: x + b - a]}" for x in range(low, high + 1)}
    return sorted(keys)


def parsed(names: DataFrame) -> DataFrame:
    """(name_domain, name, block, core, choices) of distinct (name_domain, name); ``block`` holds the closed parts.

    A short form of several first names gives rows for each of them, and a name
    of several core words one for each order; ``choices`` counts the first names.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = {
                (d, n, "|".join((p.kind, p.series, person)), core, len(p.persons))
                for d, n in zip(f["name_domain"], f["name"], strict=True) for p in readings(n) for person in p.persons for core in (p.core, p.ordered)
            }
            columns = ("name_domain", "name", "block", "core", "choices")
            yield frame(**{c: [r[i] for r in sorted(rows)] for i, c in enumerate(columns)})

    return names.mapInPandas(run, "name_domain string, name string, block string, core string, choices int")


def radius_join(cores: DataFrame, radius: int = RADIUS, cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """(block, a, b): the pairs of cores of one block within the radius, each once with a < b. ``cores`` has distinct (block, core)."""

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(f"{b}\x1f{k}", b, c, asks) for b, c in zip(f["block"], f["core"], strict=True) for asks, ks in ((False, held_keys(c, radius)), (True, asking_keys(c, radius))) for k in ks]
            yield frame(key=[r[0] for r in rows], block=[r[1] for r in rows], core=[r[2] for r in rows], asks=[r[3] for r in rows])

    # cores alone in their block have no partner: only others are keyed
    several = cores.join(cores.groupBy("block").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("block"), "block", "left_semi")
    rows = written(spread(several, "block", "core").mapInPandas(keyed, "key string, block string, core string, asks boolean"))
    # groups that may exceed a block on either side, by every 64th core; what is not cut is only slower
    side = lambda asks: F.ceil(64 * F.count_if(F.col("asks") == asks) / chunk).cast("int")
    some = rows.filter(F.pmod(F.xxhash64("core"), F.lit(64)) == 0).groupBy("key").agg(side(False).alias("n_held"), side(True).alias("n_asking"))
    large = written(some.filter("n_held > 1 or n_asking > 1"))
    own = lambda n: F.pmod(F.xxhash64("core"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    met = rows.join(large, "key", "left").withColumns({n: F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)) for n in ("n_held", "n_asking")})
    laid = met.withColumn("h", F.when(F.col("asks"), every("n_held")).otherwise(F.array(own("n_held")))).withColumn("q", F.when(F.col("asks"), F.array(own("n_asking"))).otherwise(every("n_asking")))
    laid = laid.select("key", "block", "core", "asks", F.explode("h").alias("h"), "q").select("key", "block", "core", "asks", "h", F.explode("q").alias("q")).withColumn("tie", F.xxhash64("core"))

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups come sorted, in each the held names first; a group holds at most a block of either side."""
        at, block, held, asking = None, "", [], []
        for f in frames:
            found: list[tuple[str, str, str]] = []
            for key, b, core, asks, h, q in zip(f["key"], f["block"], f["core"], f["asks"], f["h"], f["q"], strict=True):
                if (key, h, q) != at:
                    if held and asking:
                        found += [(block, *p) for p in close_pairs(held, asking, radius, cell)]
                    at, block, held, asking = (key, h, q), b, [], []
                (asking if asks else held).append(core)
            yield frame(**{c: [x[i] for x in found] for i, c in enumerate(("block", "a", "b"))})
        last = close_pairs(held, asking, radius, cell) if held and asking else []
        yield frame(block=[block] * len(last), a=[p[0] for p in last], b=[p[1] for p in last])

    return spread(laid, "key", "h", "q").sortWithinPartitions("key", "h", "q", "asks", "tie", "core").mapInPandas(join, "block string, a string, b string").distinct()


def classes(names: DataFrame) -> DataFrame:
    """(name_domain, name, class_id, links): each distinct name with its class and its number of direct links to other cores."""
    read_names = written(parsed(spread(names.filter("trim(name) != ''").distinct(), "name")).withColumn("block", F.concat_ws("|", "name_domain", "block")))
    pairs = written(radius_join(read_names.select("block", "core").distinct()))
    key = lambda c: F.concat_ws("\x1f", "block", c)
    nodes = read_names.withColumn("node", key("core"))
    # the readings of one name are one, but those of different persons stay apart
    same = nodes.groupBy("name_domain", "name", F.when(F.col("choices") > 1, F.substring_index("block", "|", -1)).alias("person")).agg(F.min("node").alias("a"), F.collect_set("node").alias("all"))
    same = same.filter("size(all) > 1").select("a", F.explode("all").alias("b")).filter("a != b")
    labels = components(pairs.select(key("a").alias("a"), key("b").alias("b")).unionByName(same))
    degree = pairs.select(key("a").alias("node")).unionByName(pairs.select(key("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    every = nodes.join(labels, "node", "left").join(degree, "node", "left").groupBy("name_domain", "name", "choices", F.coalesce("label", "node").alias("class_id")).agg(
        F.min("block").alias("block"), F.coalesce(F.max("links"), F.lit(0)).alias("links")
    )
    # a short form of several first names joins the class that a full name vouches for, else that of its first reading
    sure = every.filter("choices = 1")
    open_ = every.filter("choices > 1")
    vouched = sure.join(open_.select("class_id").distinct(), "class_id", "left_semi").groupBy("class_id").agg(F.count(F.lit(1)).alias("full"))
    best = F.min_by(F.struct("class_id", "links"), F.struct(F.coalesce("full", F.lit(0)) == 0, "block"))
    chosen = open_.join(vouched, "class_id", "left").groupBy("name_domain", "name").agg(best.alias("c")).select("name_domain", "name", "c.class_id", "c.links")
    return sure.select("name_domain", "name", "class_id", "links").unionByName(chosen)


def variants(classed: DataFrame) -> DataFrame:
    """(name_domain, name_a, name_b): the different strings of each class, name_a < name_b in byte order."""
    a = classed.select("name_domain", "class_id", F.col("name").alias("name_a"))
    b = classed.select("name_domain", "class_id", F.col("name").alias("name_b"))
    return a.join(b, ["name_domain", "class_id"]).filter("name_a < name_b").select("name_domain", "name_a", "name_b")
