"""Files in and out: CSV with required columns, JSON lines, page-banner text, manifests and profiles."""

from __future__ import annotations

import fnmatch
import json
import re
import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str | list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """CSV as strings, blank cells null, byte-order mark tolerated; missing required columns are an error."""
    df = spark.read.option("header", True).option("nullValue", "").option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def typed(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Columns cast by a schema; what can't be cast becomes null."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in schema.items()])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_pages(spark: SparkSession, path: str, banner: str = r"(?m)^=+ PAGE (\d+) =+$") -> DataFrame:
    """(path, page, text) of text files whose pages start with a banner line."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("t"))
    numbers = F.regexp_extract_all("t", F.lit(banner), 1)
    parts = F.split("t", banner)
    bodies = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return whole.select("path", F.explode(F.arrays_zip(numbers.alias("n"), bodies.alias("b"))).alias("p")).select(
        "path", F.col("p.n").cast("int").alias("page"), F.trim(F.col("p.b")).alias("text"))


def profile(df: DataFrame, date: str) -> DataFrame:
    """(n_rows, n_columns, first_date, last_date, schema_hash) in one scan of one column."""
    import hashlib

    digest = hashlib.sha256(df.schema.json().encode()).hexdigest()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(date).cast("date").alias("first_date"), F.max(date).cast("date").alias("last_date")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "first_date", "last_date", F.lit(digest).alias("schema_hash"))


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows) of each table."""
    out = None
    for name, df in sorted(tables.items()):
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the session's storage, whatever it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def select_files(spark: SparkSession, root: str, pattern: str, expected: int | None = None) -> list[str]:
    """Paths under ``root``, relative and sorted, that match a glob in which ``**`` stands for any folders; a wrong number is an error."""
    fs, top = _file_system(spark, root)
    base, found = fs.makeQualified(top).toString().rstrip("/"), []
    files = fs.listFiles(top, True)
    steps = [re.escape("\0") if s == "**" else fnmatch.translate(s).replace("(?s:", "(?:").replace(r")\Z", ")").replace(r")\z", ")").replace(".*", "[^/]*") for s in pattern.split("/")]
    shape = "/".join(steps).replace(re.escape("\0") + "/", "(?:[^/]+/)*").replace("/" + re.escape("\0"), "(?:/[^/]+)*")
    while files.hasNext():
        name = files.next().getPath().toString()[len(base) + 1:]
        if re.fullmatch(shape, name):
            found.append(name)
    if expected is not None and len(found) != expected:
        raise ValueError(f"{pattern}: {len(found)} files, expected {expected}")
    return sorted(found)


def flattened_name(path: str) -> str:
    """A relative path as one file name; :func:`unflattened_name` gives it back."""
    return "__".join(p.replace("_", "_u") for p in PurePosixPath(path).parts)


def unflattened_name(name: str) -> str:
    return "/".join(p.replace("_u", "_") for p in re.split("__", name))


def union_csv(spark: SparkSession, paths: list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """Several CSV files as one table with the columns of all in the first file's order and ``source_file``; each must have the required ones."""
    out = None
    for path in paths:
        df = read_csv(spark, path, required).withColumn("source_file", F.lit(PurePosixPath(path).name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no files")
    return out


def typed_csv(spark: SparkSession, path: str, schema: dict[str, str], null: str = "NULL") -> DataFrame:
    """CSV scanned into types; blank cells and the given string are null, what can't be cast too."""
    df = read_csv(spark, path, tuple(schema))
    return typed(df.select(*[F.when(F.col(c) != null, F.col(c)).alias(c) for c in schema]), schema)


def row_blocks(grid: DataFrame, page: str, row: str, column: str, text: str) -> DataFrame:
    """(page, row, block): the cells of a grid as one text block per table row, in order of column; a row is a printed line, so short."""
    cells = grid.filter(F.coalesce(F.trim(text), F.lit("")) != "").groupBy(page, row).agg(F.array_sort(F.collect_list(F.struct(F.col(column).cast("int").alias("c"), F.trim(text).alias("t")))).alias("a"))
    return cells.select(page, row, F.array_join(F.transform("a", lambda x: x["t"]), " | ").alias("block"))


def read_json(spark: SparkSession, path: str) -> dict:
    """A JSON configuration file, read on the driver."""
    return json.loads(_text(spark, path))


def read_config(spark: SparkSession, path: str) -> dict:
    """A configuration of nested ``key: value`` lines by indentation, with ``- item`` lists, comments and quoted texts."""

    def value(v: str):
        v = v.strip()
        if v[:1] in "\"'" and v[-1:] == v[:1] and len(v) > 1:
            return v[1:-1]
        v = re.sub(r"\s+#.*$", "", v)
        if v in ("true", "false"):
            return v == "true"
        if v in ("null", "~", ""):
            return None
        return int(v) if re.fullmatch(r"[-+]?\d+", v) else float(v) if re.fullmatch(r"[-+]?\d*\.\d+(?:[eE][-+]?\d+)?", v) else v

    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in _text(spark, path).splitlines() if x.strip() and not x.strip().startswith("#")]

    def block(i: int, depth: int):
        if lines[i][1].startswith("- "):
            items = []
            while i < len(lines) and lines[i][0] == depth and lines[i][1].startswith("- "):
                items.append(value(lines[i][1][2:]))
                i += 1
            return items, i
        out = {}
        while i < len(lines) and lines[i][0] == depth:
            key, sep, rest = lines[i][1].partition(":")
            if not sep:
                raise ValueError(f"no key: {lines[i][1]}")
            i += 1
            if not rest.strip() and i < len(lines) and (lines[i][0] > depth or (lines[i][0] == depth and lines[i][1].startswith("- "))):
                out[key.strip()], i = block(i, lines[i][0])
            else:
                out[key.strip()] = value(rest)
        return out, i

    if not lines:
        return {}
    out, end = block(0, lines[0][0])
    if end != len(lines):
        raise ValueError(f"bad indentation: {lines[end][1]}")
    return out


def _text(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path, wholetext=True).collect()  # configuration: one small file
    return "".join(r[0] for r in rows).lstrip("\ufeff")


def decision_matrix(spark: SparkSession, path: str, outputs: set[str] | None = None) -> dict[str, dict[str, str]]:
    """{context: {value: output}} of a CSV (context, value, output); repeated keys, blank fields and unknown outputs are errors."""
    out: dict[str, dict[str, str]] = {}
    for r in read_csv(spark, path, ("context", "value", "output")).collect():  # configuration: a small file
        if not r["value"] or not r["output"]:
            raise ValueError(f"blank entry: {r}")
        own = out.setdefault(r["context"] or "", {})
        if r["value"] in own:
            raise ValueError(f"repeated entry: {r['context']} {r['value']}")
        if outputs is not None and r["output"] not in outputs:
            raise ValueError(f"unknown output: {r['output']}")
        own[r["value"]] = r["output"]
    return out


def write_one_csv(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """One CSV file of that name with fixed columns in a fixed order: the same rows give the same bytes.

    For reports that fit a file; tables are written as Parquet.
    """
    fs, target = _file_system(df.sparkSession, path)
    folder = f"{path}.{uuid.uuid4().hex}"
    df.select(*columns).orderBy(*order).coalesce(1).write.option("header", True).option("emptyValue", "").option("lineSep", "\n").option("escape", '"').csv(folder)
    part = next(s.getPath() for s in fs.listStatus(_file_system(df.sparkSession, folder)[1]) if s.getPath().getName().endswith(".csv"))
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(_file_system(df.sparkSession, folder)[1], True)


def load_tables(tables: dict[str, DataFrame], folder: str, order: list[str], gate=None) -> DataFrame:
    """Tables written as Parquet, dimensions first by ``order``, beside the old ones, which they replace only when all are there.

    ``gate`` may refuse the tables before anything is written. A table that is None is skipped. Returns the manifest.
    """
    given = {n: tables[n] for n in order if tables.get(n) is not None}
    if not given:
        raise ValueError("no tables")
    if gate is not None and (why := gate(given)):
        raise ValueError(f"refused: {why}")
    spark = next(iter(given.values())).sparkSession
    fresh = f"{folder.rstrip('/')}.{uuid.uuid4().hex}"
    for name, df in given.items():
        df.write.parquet(f"{fresh}/{name}")
    fs, target = _file_system(spark, folder)
    old = _file_system(spark, f"{fresh}.old")[1]
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(_file_system(spark, fresh)[1], target)
    fs.delete(old, True)
    return manifest({n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in given})


def upsert(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows, those of the new keys replaced by the new rows."""
    return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
