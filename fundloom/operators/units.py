"""Quantities recorded in different units: a hidden Markov model per device.

The hidden state of a record is its unit. Three things are seen of it: the unit
its text states, if any; its level - log(value) + log(size of the unit) -; and
the record before it. A stated unit is an observation, not a certainty: it is
wrong with probability ``misstated``, so levels may overrule it. Levels follow a
stationary autoregression around the centre of their series,

    level' | level ~ N(centre + r (level - centre), spread^2 (1 - r^2)),

with heavy tails, which is a smooth walk where neighbours are alike (r near 1) and a level prior
where they are not (r = 0). A unit stays with probability 1 - q or is drawn
anew from the units of its series. Viterbi's best path gives each record its unit.

Nothing is fixed in advance: centre, spread and shares of the units are measured
on all stated records of a series (the quantities of one kind and dimension), r
and q on all neighbouring stated records; the smoothness of a device is that of
its series corrected by its own jumps. Where levels carry no information about
units the measured r and spread say so and the text decides alone.

Devices are hashed to partitions, which sort and decode them; a device too large
for one is range-partitioned along its order, and each partition reduces its stretch
to one max-plus matrix (best score by first and last state). The matrices are
chained to fix the states at the seams, and the stretches are decoded between
known seams. A device of any share of the rows is so spread over all partitions,
and the path is still the exact optimum.

Defined results:
* a null, zero or non-finite value, or one of no known family, carries no level:
  it gets its stated unit, or null if none is stated;
* ties go to the earlier candidate; a series without stated records has no
  levels and equal shares;
* repeated rows are kept and decoded alike; a null device is a device.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.operators.skew import hot_keys, matches
from fundloom.session import checkpoint

#: Chance that a stated unit is wrong; jump and switch chance where nothing is measured; records that such a default counts as.
MISSTATED, JUMP, SWITCH, PSEUDO = 1e-4, 0.35, 0.05, 5.0
#: Records that the jumps of a series count as beside those of a device.
DEVICE_PSEUDO = 8.0
#: Levels have heavy tails: a jump counts no more than this, a first level half of it. So neither overrules a stated unit alone; a spike, two jumps, does.
TAIL = 16.0
#: Width and number of the bins in which jumps are counted.
BIN, BINS = 0.05, 1_000


@dataclass(frozen=True)
class Model:
    """What is known of a series: sizes of its units in logs, their shares, and how its levels and units move."""

    logs: np.ndarray
    shares: np.ndarray
    centre: float | None = None
    spread: float | None = None
    jump: float = JUMP
    switch: float = SWITCH
    misstated: float = MISSTATED

    def emissions(self, stated: np.ndarray) -> np.ndarray:
        """[i, state]: log chance of what the text states."""
        n = len(self.logs)
        e = np.zeros((len(stated), n))
        said = stated >= 0
        e[said] = math.log(self.misstated / max(1, n - 1))
        e[said, stated[said]] = math.log1p(-self.misstated)
        return e

    def first(self, logv: np.ndarray) -> np.ndarray:
        """[i, state]: log chance of a device's first record."""
        start = np.broadcast_to(np.log(self.shares), (len(logv), len(self.logs)))
        if self.spread is None:
            return start
        return start - np.minimum(0.5 * ((logv[:, None] + self.logs[None, :] - self.centre) / self.spread) ** 2, TAIL / 2)

    def steps(self, logv: np.ndarray, jump: float | None = None) -> np.ndarray:
        """[i, from, to]: log chance of the moves between neighbouring records."""
        jump = self.jump if jump is None else jump
        level = logv[:, None] + self.logs[None, :]
        turn = np.log((1 - self.switch) * np.eye(len(self.logs)) + self.switch * self.shares[None, :])
        if self.spread is None:
            moved, width = level[1:, None, :] - level[:-1, :, None], jump
        else:
            r = min(max(1 - jump**2 / (2 * self.spread**2), 0.0), 0.9999)
            off = level - self.centre
            moved, width = off[1:, None, :] - r * off[:-1, :, None], self.spread * math.sqrt(1 - r * r)
        return turn[None] - np.minimum(0.5 * (moved / width) ** 2, TAIL)

    def own_jump(self, n: int, total: float) -> float:
        """The jump of a device by its own ``n`` measured ones of the squared spread ``total`` / ``n``."""
        return math.sqrt((DEVICE_PSEUDO * self.jump**2 + total) / (DEVICE_PSEUDO + n))


def matrix(model: Model, logv: np.ndarray, stated: np.ndarray, jump: float | None = None, starts: bool = True) -> np.ndarray:
    """Best score of a stretch by its first and last state; ``starts`` if it is a device's first."""
    e, n = model.emissions(stated), len(model.logs)
    head = e[0] + (model.first(logv[:1])[0] if starts else 0.0)
    m = np.where(np.eye(n, dtype=bool), head[None, :], -np.inf)
    for step, emission in zip(model.steps(logv, jump), e[1:], strict=True):
        m = (m[:, :, None] + step[None]).max(axis=1) + emission[None]
    return m


def viterbi(model: Model, logv, stated, jump: float | None = None, first: int | None = None, last: int | None = None) -> list[int]:
    """The best states of one stretch, optionally with its first and last state given."""
    logv, stated = np.asarray(logv, float), np.asarray(stated, int)
    e = model.emissions(stated)
    score, back = e[0] + model.first(logv[:1])[0], []
    if first is not None:
        score = np.where(np.arange(len(score)) == first, 0.0, -np.inf)
    for step, emission in zip(model.steps(logv, jump), e[1:], strict=True):
        moves = score[:, None] + step
        back.append(moves.argmax(axis=0))
        score = moves.max(axis=0) + emission
    state = int(score.argmax()) if last is None else last
    path = [state]
    for b in reversed(back):
        state = int(b[state])
        path.append(state)
    return path[::-1]


def _jumps(model: Model, logv: np.ndarray, stated: np.ndarray) -> np.ndarray:
    """Level jumps between neighbouring records that both state their unit; NaN elsewhere."""
    level = np.where(stated >= 0, logv + model.logs[np.maximum(stated, 0)], np.nan)
    return np.diff(level)


def _spread_of_jumps(model: Model, logv: np.ndarray, stated: np.ndarray) -> tuple[int, float]:
    """(number of measured jumps of a stretch, that times their squared robust spread)."""
    jumps = _jumps(model, logv, stated)
    jumps = np.abs(jumps[~np.isnan(jumps)])
    return len(jumps), float(len(jumps) * (np.median(jumps) / 0.6745) ** 2) if len(jumps) else 0.0


def models(chain: DataFrame, names: dict[str, list[str]], logs: dict[str, np.ndarray], misstated: float) -> dict[str, Model]:
    """The series of ``chain`` with what their stated records tell of levels and shares; jumps are not measured yet."""
    level = F.when(F.col("__s") >= 0, F.col("__v") + F.element_at(F.lit([[float(x) for x in logs[f]] for f in names]), F.col("__f") + 1)[F.greatest("__s", F.lit(0))])
    at = F.percentile_approx(level, F.lit([0.25, 0.5, 0.75]), F.lit(10_000))
    levels = {r["__series"]: r["q"] for r in chain.groupBy("__series").agg(at.alias("q")).collect()}  # one row a series
    counts: dict[str, dict[int, int]] = {s: {} for s in levels}
    for r in chain.filter("__s >= 0").groupBy("__series", "__s").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a series and unit
        counts[r["__series"]][r["__s"]] = r["n"]
    out = {}
    for series, q in levels.items():
        family = list(names)[int(series.rsplit("|", 1)[-1])]
        n = len(names[family])
        seen = np.array([counts[series].get(i, 0) for i in range(n)], float) + 1.0
        spread = None if q is None else max((q[2] - q[0]) / 1.349, 0.05)
        out[series] = Model(logs[family], seen / seen.sum(), None if q is None else q[1], spread, misstated=misstated)
    return out


def decode(
    df: DataFrame, device: list[str], order: list[str], value: str, stated: str, units: dict[str, list[tuple[str, float]]], family: str,
    out: str = "unit", series: tuple[str, ...] = (), misstated: float = MISSTATED,
) -> DataFrame:
    """``df`` with the decoded unit of each record in column ``out``.

    ``units`` gives per family (dimension) the candidate units with the size of
    one in base units; ``family`` is the column that holds a record's family and
    belongs to the device. Devices of one ``series`` share what is measured:
    there are as many as kinds of quantities, so few.
    """
    names = {f: [u for u, _ in us] for f, us in units.items()}
    logs = {f: np.array([math.log(size) for _, size in us]) for f, us in units.items()}
    size = F.abs(F.col(value).cast("double"))
    known = F.try_element_at(F.create_map(*[x for i, f in enumerate(names) for x in (F.lit(f), F.lit(i))]), F.col(family))
    usable = F.coalesce((size > 0) & (size < float("inf")) & known.isNotNull(), F.lit(False))
    index = F.create_map(*[x for f, us in names.items() for i, u in enumerate(us) for x in (F.lit(f"{f}|{u}"), F.lit(i))])
    keys = [*device, family]
    text = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    tagged = df.withColumns({
        "__usable": usable, "__v": F.log(size), "__f": known, "__d": F.xxhash64(*text), "__e": F.xxhash64(F.lit(1), *text),
        "__s": F.when(F.col(stated).isNull(), -1).otherwise(F.coalesce(F.try_element_at(index, F.concat_ws("|", family, stated)), F.lit(-1))),
        "__series": F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in series], known.cast("string")),
        "__tie": F.xxhash64(*[F.col(c) for c in df.columns]),  # records of one moment come in a fixed order
    })
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, long computing: not to be coalesced
    by = ("__d", "__e", *order, "__tie")
    # devices are whole in a hash partition; only those too large for one are cut along their order
    large = hot_keys(df.select(*device), list(device), share=1 / (2 * parts)) if parts > 1 else []
    cut = matches(list(device), large)
    laid = [tagged.filter(~cut).repartition(parts, "__d"), tagged.filter(cut).repartitionByRange(parts, *by)] if large else [tagged.repartition(parts, "__d")]
    sorted_ = [x.sortWithinPartitions(*by).drop("__tie").withColumn("__part", F.spark_partition_id() + i * parts) for i, x in enumerate(laid)]
    everything = checkpoint(sorted_[0].unionByName(sorted_[1]) if large else sorted_[0])
    settled = everything.filter("not __usable").withColumn(out, F.col(stated).cast("string")).select(*df.columns, out)
    ordered = everything.filter("__usable")
    known_models = models(ordered, names, logs, misstated)
    if not known_models:
        return settled
    known_models, own, across = _measured(ordered, known_models)
    ends = _seams(ordered, known_models, own, across)
    listed = [names[f] for f in names]

    def decoded(t: pa.Table) -> pa.Array:
        """Units of whole devices, or of stretches whose ends are known."""
        v, s, f, part, cuts, ids, kinds = _columns(t)
        found = np.zeros(len(v), dtype=object)
        lengths = np.diff(np.r_[cuts, len(v)])
        single = cuts[lengths == 1]
        single = single[[(part[a], *ids(a)) not in ends for a in single]] if ends else single
        for kind in set(kinds[single].tolist()):  # most devices may have one record: all at once
            at = single[kinds[single] == kind]
            model = known_models[kind]
            for i in range(0, len(at), 1 << 16):
                some = at[i: i + (1 << 16)]
                best = (model.emissions(s[some]) + model.first(v[some])).argmax(axis=1)
                found[some] = np.array(listed[f[some[0]]], dtype=object)[best]
        done = set(single.tolist())
        for a, n in zip(cuts.tolist(), lengths.tolist(), strict=True):
            if a in done:
                continue
            model, x, st = known_models[kinds[a]], v[a: a + n], s[a: a + n]
            end = ends.get((part[a], *ids(a)), (None, None))
            jump = own.get(ids(a)) or model.own_jump(*_spread_of_jumps(model, x, st))
            found[a: a + n] = [listed[f[a]][i] for i in viterbi(model, x, st, jump, *end)]
        return pa.array(found, pa.string())

    columns = [c for c in ordered.columns if not c.startswith("__") or c in df.columns]
    schema = ordered.select(*columns).withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_devices(batches):
            yield from t.select(columns).append_column(out, decoded(t)).to_batches()

    return settled.unionByName(ordered.mapInArrow(run, schema).select(*df.columns, out))


def _columns(t: pa.Table):
    v, s, f, part, d, e = (t.column(c).to_numpy() for c in ("__v", "__s", "__f", "__part", "__d", "__e"))
    cuts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (e[1:] != e[:-1])])
    kinds = np.array(t.column("__series").to_pylist(), dtype=object)
    return v, s, f, part, cuts, lambda a: (int(d[a]), int(e[a])), kinds


def _whole_devices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a sorted partition in tables that each end with a device."""
    held: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        d, e = t.column("__d").to_numpy(), t.column("__e").to_numpy()
        turns = np.flatnonzero((d[1:] != d[:-1]) | (e[1:] != e[:-1]))
        last = int(turns[-1]) + 1 if len(turns) else 0
        if held and (held[-1].column("__d")[-1].as_py(), held[-1].column("__e")[-1].as_py()) != (int(d[0]), int(e[0])):
            yield pa.concat_tables(held)
            held = []
        if last:
            yield pa.concat_tables([*held, t.slice(0, last)])
            held = []
        held.append(t.slice(last))
    if held:
        yield pa.concat_tables(held)


_MEASURES = "__part int, what string, d bigint, e bigint, series string, level double, state int, bin int, n bigint, total double"


def _measured(ordered: DataFrame, known: dict[str, Model]) -> tuple[dict[str, Model], dict[tuple[int, int], float], set[tuple[int, int]]]:
    """(models with their jumps and switches, jumps of the devices that cross partitions, those devices).

    The driver gets a histogram per series and four rows a partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        bins: dict[tuple[str, str, int], int] = {}
        before = None
        for t in _whole_devices(batches):
            v, s, _, part, cuts, ids, kinds = _columns(t)
            ends = np.r_[cuts[1:], len(v)]
            inside = np.ones(len(v), bool)
            inside[cuts] = False
            for kind in set(kinds.tolist()):
                own = kinds == kind
                model = known[kind]
                jump = np.r_[np.nan, _jumps(model, v, np.where(own, s, -1))]
                good = own & inside & ~np.isnan(jump)
                if good.any():
                    for b, n in zip(*np.unique(np.minimum(np.abs(jump[good]) / BIN, BINS).astype(int), return_counts=True), strict=True):
                        bins["jump", kind, int(b)] = bins.get(("jump", kind, int(b)), 0) + int(n)
                    turned = (np.r_[-1, s[:-1]] != s)[good]
                    bins["turn", kind, int(1)] = bins.get(("turn", kind, 1), 0) + int(turned.sum())
            level = lambda i: (float(v[i] + known[kinds[i]].logs[s[i]]) if s[i] >= 0 else None, int(s[i]))

            def device(a: int, b: int) -> tuple:
                return _spread_of_jumps(known[kinds[a]], v[a:b], s[a:b])

            if before is None:
                rows.append((int(part[0]), "first", *ids(0), kinds[0], *level(0), None, *device(int(cuts[0]), int(ends[0]))))
            before = (int(part[-1]), "last", *ids(len(v) - 1), kinds[-1], *level(len(v) - 1), None, *device(int(cuts[-1]), int(ends[-1])), len(cuts))
        if before is not None:
            rows.append(before[:-1])
        rows += [(None, what, None, None, kind, None, None, b, n, None) for (what, kind, b), n in bins.items()]
        names = [c.split()[0] for c in _MEASURES.split(", ")]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    m = ordered.mapInArrow(run, _MEASURES)
    keys = ["__part", "what", "d", "e", "series", "level", "state", "bin", "total"]
    got = m.groupBy(*keys).agg(F.sum("n").alias("n")).collect()
    jumps: dict[str, dict[int, int]] = {}
    turns: dict[str, int] = {}
    for r in got:
        if r["what"] == "jump":
            jumps.setdefault(r["series"], {})[r["bin"]] = r["n"]
        elif r["what"] == "turn":
            turns[r["series"]] = r["n"]
    edges = {(r["__part"], r["what"]): r for r in got if r["what"] in ("first", "last")}
    order = sorted({p for p, _ in edges})
    across, sums = set(), {}
    for p in order:  # what a crossing device has in each partition; one that is both first and last counts once
        for r in {(edges[p, w]["d"], edges[p, w]["e"]): edges[p, w] for w in ("first", "last")}.values():
            n, total = sums.get((r["d"], r["e"]), (0, 0.0))
            sums[r["d"], r["e"]] = (n + r["n"], total + r["total"])
    for p, q in zip(order, order[1:], strict=False):
        a, b = edges[p, "last"], edges[q, "first"]
        if (a["d"], a["e"]) == (b["d"], b["e"]):
            key = (a["d"], a["e"])
            across.add(key)
            if a["level"] is not None and b["level"] is not None:
                jump = abs(a["level"] - b["level"])
                of = jumps.setdefault(a["series"], {})
                at = int(min(jump / BIN, BINS))
                of[at] = of.get(at, 0) + 1
                turns[a["series"]] = turns.get(a["series"], 0) + (a["state"] != b["state"])
    out = {}
    for series, model in known.items():
        hist = jumps.get(series, {})
        n = sum(hist.values())
        middle, seen = 0.0, 0
        for b in sorted(hist):
            if seen + hist[b] >= n / 2:
                middle = (b + (n / 2 - seen) / hist[b]) * BIN
                break
            seen += hist[b]
        robust = middle / 0.6745
        alike = float((model.shares**2).sum())
        q = min(1.0, turns.get(series, 0) / n / max(1e-9, 1 - alike)) if n else 0.0
        out[series] = Model(
            model.logs, model.shares, model.centre, model.spread, math.sqrt((PSEUDO * JUMP**2 + n * robust**2) / (PSEUDO + n)),
            min(max((PSEUDO * SWITCH + n * q) / (PSEUDO + n), 1e-6), 1 - 1e-9), model.misstated,
        )
    series_of = {(r["d"], r["e"]): r["series"] for r in edges.values()}
    own = {key: out[series_of[key]].own_jump(*sums[key]) for key in across}
    return out, own, across


def _seams(ordered: DataFrame, known: dict[str, Model], own: dict[tuple[int, int], float], across: set[tuple[int, int]]) -> dict[tuple, tuple[int, int]]:
    """{(partition, device): (first, last state)} of the stretches of devices that cross partitions: two a partition at most."""
    if not across:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for t in _whole_devices(batches):
            v, s, _, part, cuts, ids, kinds = _columns(t)
            for a, b in zip(cuts, np.r_[cuts[1:], len(v)], strict=True):
                if ids(a) in across:
                    m = matrix(known[kinds[a]], v[a:b], s[a:b], own[ids(a)], starts=False)
                    rows.append((*ids(a), int(part[a]), kinds[a], float(v[a]), float(v[b - 1]), m.ravel().tolist()))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["d", "e", "part", "kind", "first", "last", "m"])

    def chained(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("part")
        model, jump = known[g["kind"].iloc[0]], own[int(g["d"].iloc[0]), int(g["e"].iloc[0])]
        n = len(model.logs)
        ms = [np.array(m).reshape(n, n) for m in g["m"]]
        ms[0] = ms[0] + model.first(np.array([g["first"].iloc[0]]))[0][:, None]
        best, picks, entries = ms[0].max(axis=0), [ms[0].argmax(axis=0)], []
        for k in range(1, len(ms)):
            moves = best[:, None] + model.steps(np.array([g["last"].iloc[k - 1], g["first"].iloc[k]]), jump)[0]
            entries.append(moves.argmax(axis=0))
            total = moves.max(axis=0)[:, None] + ms[k]
            picks.append(total.argmax(axis=0))
            best = total.max(axis=0)
        state = int(best.argmax())
        firsts, lasts = [0] * len(ms), [0] * len(ms)
        for k in range(len(ms) - 1, -1, -1):
            lasts[k], firsts[k] = state, int(picks[k][state])
            if k:
                state = int(entries[k - 1][firsts[k]])
        return pd.DataFrame({"d": g["d"], "e": g["e"], "part": g["part"], "a": firsts, "b": lasts})

    stretches = ordered.mapInArrow(run, "d bigint, e bigint, part int, kind string, first double, last double, m array<double>")
    ends = stretches.groupBy("d", "e").applyInPandas(chained, "d bigint, e bigint, part int, a int, b int").collect()
    return {(r["part"], r["d"], r["e"]): (r["a"], r["b"]) for r in ends}
