"""Keyword, vector and hybrid retrieval."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z0-9]+)"), 1)


def bm25(docs: DataFrame, key: str, text: str, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) of documents holding a query term; statistics cover all documents.

    The query is a few words, so term frequencies are array filters over each
    document and only one row of corpus statistics is shared.
    """
    words = docs.select(key, tokens(F.col(text)).alias("w"))

    def equals(q: str):
        return lambda x: x == F.lit(q)

    tf = [F.size(F.filter("w", equals(q))).cast("double") for q in query]
    counted = words.select(key, F.size("w").cast("double").alias("len"), *[t.alias(f"tf{i}") for i, t in enumerate(tf)])
    stats = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("avg"), *[F.sum((F.col(f"tf{i}") > 0).cast("int")).alias(f"df{i}") for i in range(len(query))])
    scored = counted.filter(" or ".join(f"tf{i} > 0" for i in range(len(query)))).join(F.broadcast(stats))  # one row
    score = sum(
        (
            F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
            * F.col(f"tf{i}") * (k1 + 1) / (F.col(f"tf{i}") + k1 * (1 - b + b * F.col("len") / F.col("avg")))
        )
        for i in range(len(query))
    )
    return scored.select(key, score.alias("score"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two float arrays."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def fuse(lists: list[tuple[DataFrame, float]], *key: str, k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists of (key, rank): the sum of weight / (k + rank)."""
    parts = [df.select(*key, (F.lit(w) / (k + F.col("rank"))).alias("s")) for df, w in lists]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*key).agg(F.sum("s").alias("score"))


def top(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """The n best by score, ties by key, with their rank. The sort is a distributed top-k; only n rows are ranked."""
    return df.orderBy(F.desc(score), key).limit(n).withColumn("rank", F.row_number().over(W.orderBy(F.desc(score), key)))


#: Rows and queries scored at once by :func:`_each`: a block of scores has 8,192 x 1,024 doubles at most, 64 MB, but for uneven hashing.
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
#: Terms that at least this share of a block's queries have are scored by a dense product, others posting by posting.
DENSE_SHARE = 1 / 64


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n best of ``scores``, ties by id."""
    if len(scores) > n:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:n]]


def _each(queries: DataFrame, rows: DataFrame, key: str, n: int, score: Callable[[pa.Table, pa.Table], np.ndarray]) -> DataFrame:
    """(query_id, key, score, s, rank): for each query the n best of all rows by ``s``, the score to nine digits, ties by key.

    Blocks of queries meet blocks of rows; of each meeting a query keeps n rows,
    so what is ranked is bounded by n per query and block. ``score`` gives a
    matrix (queries, rows); what is not finite is no result.
    """
    row_blocks, query_blocks = (max(1, math.ceil(df.count() / size)) for df, size in ((rows, ROW_BLOCK), (queries, QUERY_BLOCK)))

    def block(c: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = queries.withColumn("qb", block("query_id", query_blocks)).withColumn("rb", every(row_blocks))
    right = rows.withColumn("rb", block(key, row_blocks)).withColumn("qb", every(query_blocks))

    def scored(q: pa.Table, r: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [])
        if q.num_rows and r.num_rows:
            of, ids = q["query_id"].to_numpy(), r[key].to_numpy()
            for query_id, own in zip(of, score(q, r)):
                there = np.flatnonzero(np.isfinite(own))
                at = there[_best(ids[there], np.round(own[there], 9), n)]
                for column, values in zip(out, (np.full(len(at), query_id), ids[at], own[at])):
                    column.append(values)
        whole = [np.concatenate(x) if x else np.array([]) for x in out]
        return pa.table({"query_id": pa.array(whole[0], pa.int64()), key: pa.array(whole[1], pa.int64()), "score": pa.array(whole[2], pa.float64()), "s": pa.array(np.round(whole[2], 9), pa.float64())})

    kept = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(scored, f"query_id bigint, {key} bigint, score double, s double")
    w = W.partitionBy("query_id").orderBy(F.desc("s"), key)
    return kept.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def nearest_each(vectors: DataFrame, key: str, vector: str, asked: str, n: int) -> DataFrame:
    """The n rows of greatest cosine for each row that meets ``asked``, itself among them; a null or zero vector has no cosine."""
    v = vectors.select(key, F.col(vector).cast("array<double>").alias("v")).filter(F.exists("v", lambda x: x != 0))

    def score(q: pa.Table, r: pa.Table) -> np.ndarray:
        a, b = (pc.list_flatten(t[c]).to_numpy().reshape(t.num_rows, -1) for t, c in ((q, "asked"), (r, "v")))
        return (a @ b.T) / np.sqrt(np.outer((a * a).sum(axis=1), (b * b).sum(axis=1)))

    return _each(v.filter(asked).select(F.col(key).alias("query_id"), F.col("v").alias("asked")), v, key, n, score)


def bm25_each(docs: DataFrame, key: str, text: str, asked: str, n: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The n best documents for each document that meets ``asked``, its distinct terms the query; it is among them.

    Statistics cover all documents; only documents holding a term of the query are results.
    """
    words = docs.select(key, tokens(F.col(text)).alias("w"))
    count, average = words.agg(F.count(F.lit(1)), F.avg(F.size("w"))).first()
    distinct = words.select(key, F.explode(F.array_distinct("w")).alias("term"))
    held = distinct.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = distinct.filter(asked).join(held, "term").select(
        F.col(key).alias("query_id"), F.struct("term", F.log(1 + (count - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")).alias("t")
    )
    queries = weighted.groupBy("query_id").agg(F.collect_list("t").alias("t")).select("query_id", F.col("t.term").alias("term"), F.col("t.idf").alias("idf"))

    def score(q: pa.Table, r: pa.Table) -> np.ndarray:
        n_q, n_r = q.num_rows, r.num_rows
        q_len, r_len = (pc.list_value_length(t[c]).to_numpy() for t, c in ((q, "term"), (r, "w")))
        coded = pc.list_flatten(q["term"]).combine_chunks().dictionary_encode()
        q_of, q_term, idf = np.repeat(np.arange(n_q), q_len), coded.indices.to_numpy(), pc.list_flatten(q["idf"]).to_numpy()
        n_t = len(coded.dictionary)
        known = pc.index_in(pc.list_flatten(r["w"]).combine_chunks(), value_set=coded.dictionary)
        there = known.is_valid().to_numpy(zero_copy_only=False)
        at = np.repeat(np.arange(n_r), r_len)[there] * n_t + known.drop_null().to_numpy()
        pairs, tf = np.unique(at, return_counts=True)
        r_of, r_term = pairs // n_t, pairs % n_t
        gain = tf * (k1 + 1) / (tf + k1 * (1 - b + b * r_len[r_of] / average))
        out, having = np.zeros((n_q, n_r)), np.bincount(q_term, minlength=n_t)
        often = having >= max(2, DENSE_SHARE * n_q)
        place = np.cumsum(often) - 1
        dense_q, dense_r = np.zeros((n_q, often.sum())), np.zeros((n_r, often.sum()))
        q_often, r_often = often[q_term], often[r_term]
        dense_q[q_of[q_often], place[q_term[q_often]]] = idf[q_often]
        dense_r[r_of[r_often], place[r_term[r_often]]] = gain[r_often]
        np.matmul(dense_q, dense_r.T, out=out)
        order = np.argsort(q_term, kind="stable")
        first = np.cumsum(having) - having
        r_of, r_term, gain = r_of[~r_often], r_term[~r_often], gain[~r_often]
        for i in range(0, len(r_of), 1 << 17):  # one posting meets fewer than 16 queries here, so a slice has 2 million pairs at most
            d, t, g = r_of[i : i + (1 << 17)], r_term[i : i + (1 << 17)], gain[i : i + (1 << 17)]
            times = having[t]
            posting = np.repeat(np.arange(len(t)), times)
            entry = order[first[t][posting] + np.arange(len(posting)) - (np.cumsum(times) - times)[posting]]
            np.add.at(out, (q_of[entry], d[posting]), idf[entry] * g[posting])
        return np.where(out > 0, out, -np.inf)

    return _each(queries, words, key, n, score)
