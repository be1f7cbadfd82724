"""Readers and writers: ordered JSON lines, Parquet, token tables, catalogs, blends and training logs."""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ordering import prefix_sum


def read_table(spark: SparkSession, path: str, *cols: str) -> DataFrame:
    """A Parquet table, or some of its columns, as the scan splits it."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def read_parquet(spark: SparkSession, path: str, text_key: str = "text", id_key: str | None = None) -> DataFrame:
    """Documents from Parquet.  ``id_key`` names the column that holds their order; rows are not sorted by
    it here, consumers that need the order use the column."""
    df = spark.read.parquet(path)
    require_text_key(df, text_key)
    if id_key:
        require_text_key(df, id_key)
    return df


def require_text_key(df: DataFrame, key: str) -> None:
    """Fail early, naming the columns that do exist."""
    if key not in df.columns:
        raise ValueError(f"text key {key!r} not found; available: {', '.join(df.columns)}")


def validate_text_key(df: DataFrame, key: str, corrupt: str = "_corrupt_record") -> DataFrame:
    """One row: rows in total, and rows with a missing, blank or unparsable text."""
    require_text_key(df, key)
    bad = F.col(corrupt).isNotNull() if corrupt in df.columns else F.lit(False)
    null = F.col(key).isNull() & ~bad
    blank = F.col(key).isNotNull() & (F.length(F.trim(F.col(key).cast("string"))) == 0)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(null).alias("n_null"),
        F.count_if(blank).alias("n_blank"),
        F.count_if(bad).alias("n_corrupt"),
        F.count_if(~null & ~blank & ~bad).alias("n_usable"),
    )


def numbered_lines(spark: SparkSession, paths: list[str] | str, in_parts: bool = False) -> DataFrame:
    """Text lines with ``file_path`` and ``line_no`` (from 0), besides ``value`` and partition columns.

    With ``in_parts`` the files of a folder are the parts of one, by name: its path is the folder's, and its lines
    are numbered through.

    Rows of a split are numbered as they are scanned; the splits of each file, one row for each, are counted
    and summed up, and travel back to the lines.  Files of any size are read in parallel.
    """
    raw = spark.read.text(paths)
    raw = raw.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_n"),
    )
    splits = raw.groupBy("file_path", "_at").agg(F.min("_n").alias("_first"), F.count("*").alias("_rows"))
    whole = F.regexp_replace("file_path", "/[^/]*$", "") if in_parts else F.col("file_path")
    over = W.partitionBy(whole).orderBy("file_path", "_at")
    before = splits.select("file_path", "_at", (F.sum("_rows").over(over) - F.col("_rows") - F.col("_first")).alias("_off"))
    lines = raw.join(F.broadcast(before), ["file_path", "_at"])  # one row per scan task
    return lines.withColumns({"line_no": F.col("_off") + F.col("_n"), "file_path": whole}).drop("_at", "_n", "_off")


def _file_numbers(files: list[str], order: list[str] | None) -> list[tuple[str, int]]:
    """Numbers from 1: by path, or as listed; a listed name stands for the one path that ends in it."""
    if order is None:
        return [(f, i + 1) for i, f in enumerate(sorted(files))]
    out = []
    for i, name in enumerate(order):
        found = [f for f in files if f == name or f.endswith("/" + name.lstrip("/"))]
        if len(found) != 1:
            raise ValueError(f"{name!r} stands for {len(found)} of the files read")
        out.append((found[0], i + 1))
    return out


def read_jsonl(
    spark: SparkSession, paths: list[str] | str, schema: T.StructType, file_order: list[str] | None = None, in_parts: bool = False
) -> DataFrame:
    """JSON lines of several files in one scan, in the order (``file_index``, ``line_no``).

    Columns missing from a file are null, broken lines are in ``_corrupt_record``, blank ones are left out
    (but counted by ``line_no``, which starts at 0).  A file is its whole path; files are numbered by path, or
    as ``file_order`` lists them, which then also selects them.  With ``in_parts`` a folder is a file, as several
    tasks write it, and its files are the parts by name.
    """
    lines = numbered_lines(spark, paths, in_parts)
    names = [unquote(f) for f in lines.inputFiles()]
    names = sorted({f.rsplit("/", 1)[0] for f in names}) if in_parts else names
    files = [(unquote(f), i) for f, i in _file_numbers(names, file_order)]
    numbered = spark.createDataFrame([(_plain(f), i) for f, i in files], "_file string, file_index int")
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    plain = F.regexp_replace(F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))), "^([a-z]+):/+", "$1:/")
    rows = lines.where(F.trim("value") != "").withColumn("_file", plain).join(F.broadcast(numbered), "_file")
    others = [c for c in lines.columns if c not in ("value", "file_path", "line_no")]
    return rows.select(
        F.from_json("value", full, options).alias("_r"),
        *others,
        "file_path",
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
        "file_index",
        "line_no",
    ).select("_r.*", *others, "file_path", "file_name", "file_index", "line_no")


def _plain(path: str) -> str:
    """A path with one slash after its scheme, however it is written."""
    return re.sub("^([a-z]+):/+", r"\1:/", path)


def write_jsonl(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write
    (writer.partitionBy(by) if by else writer).json(path)


def pending(inputs: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Inputs that the manifest of finished conversions does not list."""
    return inputs.join(manifest.select(key), key, "left_anti")


def write_tokens(tokens: DataFrame, path: str, by: str = "dataset") -> None:
    """Token table partitioned by dataset.

    The rebalance hint splits a dataset with a third of all rows over many tasks and keeps small ones
    from leaving a file per task.
    """
    tokens.hint("rebalance", by).write.partitionBy(by).parquet(path)


def merge_shards(
    shards: DataFrame,
    shard: str,
    local: str,
    order: Column,
    width: int = 1_000_000,
    out: str = "global_id",
) -> DataFrame:
    """One document namespace over all shards: ids follow (``order`` of the shard, local position).

    Shard blocks of ``width`` local positions are counted and summed up inside their shard; only the
    totals of the shards, one row each, are summed up in one place.
    """
    blocks = shards.withColumns({"_o": order, "_block": F.floor(F.col(local) / width)})
    inside = prefix_sum(blocks, "_block", [local], F.lit(1).cast("long"), "_in", ("_o",))
    totals = blocks.groupBy("_o").agg(F.count("*").alias("_t"))
    before = totals.select("_o", (F.sum("_t").over(W.orderBy("_o")) - F.col("_t")).alias("_off"))
    return inside.join(F.broadcast(before), "_o").withColumn(out, F.col("_off") + F.col("_in")).drop("_o", "_block", "_off", "_in")


def numeric_suffix(shard: str) -> Column:
    """Orders shards by the number in their name, the rule for partition shards."""
    return F.regexp_extract(shard, r"(\d+)$", 1).cast("long")


def read_catalog(spark: SparkSession, tree: dict | str, tokens_key: str = "tokens") -> DataFrame:
    """language > quality > domain > [{name, tokens}] as rows (lang, quality, domain, dataset, tokens).

    ``tree`` is the parsed configuration or the path of a JSON file.
    """
    entry = f"array<struct<name: string, `{tokens_key}`: bigint>>"
    kind = f"map<string, map<string, map<string, {entry}>>>"
    if isinstance(tree, str):
        raw = spark.read.text(tree, wholetext=True)
    else:
        raw = spark.createDataFrame([(json.dumps(tree),)], "value string")
    return (
        raw.select(F.explode(F.from_json("value", kind)).alias("lang", "_q"))
        .select("lang", F.explode("_q").alias("quality", "_d"))
        .select("lang", "quality", F.explode("_d").alias("domain", "_l"))
        .select("lang", "quality", "domain", F.explode("_l").alias("_e"))
        .select("lang", "quality", "domain", F.col("_e.name").alias("dataset"), F.col(f"_e.{tokens_key}").alias("tokens"))
    )


def write_catalog(catalog: DataFrame, path: str, tokens_key: str = "tokens") -> None:
    """The catalog rows as one nested JSON document (a configuration file, one entry per dataset)."""
    leaf = catalog.groupBy("lang", "quality", "domain").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(F.col("dataset").alias("name"), F.col("tokens").alias(tokens_key)))))
        .alias("_e")
    )
    entry = f"array<struct<name: string, `{tokens_key}`: bigint>>"
    leaf = leaf.withColumn("_e", F.from_json("_e", entry))
    domains = leaf.groupBy("lang", "quality").agg(F.map_from_entries(F.collect_list(F.struct("domain", "_e"))).alias("_d"))
    qualities = domains.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("quality", "_d"))).alias("_q"))
    tree = qualities.agg(F.map_from_entries(F.collect_list(F.struct("lang", "_q"))).alias("_t"))
    tree.select(F.to_json("_t").alias("value")).coalesce(1).write.text(path)


def check_sources(catalog: DataFrame, available: DataFrame, fail: bool = True) -> DataFrame:
    """Catalog entries without data; raises with their names unless ``fail`` is off."""
    missing = catalog.join(available.select("dataset").distinct(), "dataset", "left_anti")
    if fail:
        names = [r[0] for r in missing.select("dataset").orderBy("dataset").limit(50).collect()]
        if names:
            n = missing.count()
            more = f" and {n - len(names)} more" if n > len(names) else ""
            raise ValueError(f"no data for {n} datasets: " + ", ".join(names) + more)
    return missing


BLEND_FIELDS = "split string, position int, dataset string, weight double"
SPLITS = ("train", "valid", "test")


def _pairs(items: list) -> list[tuple[str, float | None]]:
    """[w, path, w, path, ...], or paths alone (then every weight is null)."""

    def number(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return None

    flat = list(items)
    if len(flat) % 2 == 0 and flat and all(number(x) is not None for x in flat[0::2]):
        return [(str(p), number(w)) for w, p in zip(flat[0::2], flat[1::2])]
    return [(str(p), None) for p in flat]


def _whole_files(spark: SparkSession, path: str) -> list[str]:
    """The texts of a configuration: one file, or all parts of a folder in the order of their names."""
    return [r[1] for r in spark.read.text(path, wholetext=True).select("_metadata.file_path", "value").orderBy("file_path").collect()]


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def read_blend(
    spark: SparkSession,
    blend: list | str | tuple | None = None,
    per_split: dict | str | None = None,
) -> DataFrame:
    """Blend rows from a flat list, ``([paths], [weights])``, a text file, or per-split lists / JSON file.

    The two forms exclude each other; a text file is given as ``blend="path"`` and a JSON file as
    ``per_split="path"``.
    """
    if (blend is None) == (per_split is None):
        raise ValueError("give exactly one of blend and per_split")
    rows: list[tuple] = []
    if blend is not None:
        if isinstance(blend, str):
            blend = " ".join(_whole_files(spark, blend)).split()
        if isinstance(blend, tuple):
            pairs = list(zip(blend[0], [float(w) for w in blend[1]]))
        else:
            pairs = _pairs(blend)
        rows = [("all", i, p, w) for i, (p, w) in enumerate(pairs)]
    else:
        if isinstance(per_split, str):
            texts = _whole_files(spark, per_split)
            per_split = {k: v for t in texts for line in ([t] if _is_json(t) else t.splitlines()) if line.strip() for k, v in json.loads(line).items()}
        for split in SPLITS:
            items = per_split.get(split) or []
            items = items.split() if isinstance(items, str) else items
            if items and isinstance(items[0], (list, tuple)):
                items = [x for pair in items for x in pair]
            rows += [(split, i, p, w) for i, (p, w) in enumerate(_pairs(items))]
    return spark.createDataFrame(rows, BLEND_FIELDS)


def write_blend(weights: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """One row with the interleaved list: zero weights dropped, the rest must add up to one.

    The sum is reported, and the list is null where it is off, so a broken mix cannot be used.
    """
    live = weights.where(F.col("weight") > 0)
    total = F.sum("weight")
    pairs = F.sort_array(F.collect_list(F.struct("dataset", "weight")))
    flat = F.flatten(F.transform(pairs, lambda x: F.array(x["weight"].cast("string"), x["dataset"])))
    ok = F.abs(total - 1) <= tolerance
    return live.agg(
        F.count("*").alias("n_datasets"), total.alias("total"), ok.alias("ok"), F.when(ok, flat).alias("blend")
    )


def explode_blend(blend: DataFrame) -> DataFrame:
    """Rows (dataset, weight) of an interleaved list column."""
    pairs = blend.select(F.posexplode("blend").alias("i", "v")).withColumn("pair", F.floor(F.col("i") / 2))
    return pairs.groupBy("pair").agg(
        F.max(F.when(F.col("i") % 2 == 1, F.col("v"))).alias("dataset"),
        F.max(F.when(F.col("i") % 2 == 0, F.col("v"))).cast("double").alias("weight"),
    )


def read_train_log(spark: SparkSession, paths: list[str] | str, run: Column | None = None) -> DataFrame:
    """Training log lines with the values they carry: (run, line_no, step_time, tflops, mem_gb).

    A run is a file, named by its whole path or by ``run``, an expression over ``file_path`` and partition
    columns; ``line_no`` is the line's place in the file.  Lines need no prefix of any kind.
    """
    lines = numbered_lines(spark, paths)
    return parse_train_log(lines.select((F.col("file_path") if run is None else run).alias("run"), "line_no", "value"))


def parse_train_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add step_time and tflops (on lines that hold both) and mem_gb."""
    # The three log markers.
    step = r"Step Time : ([0-9.]+)s.*GPU utilization: ([0-9.]+)"
    mem = r"mem-allocated-gigabytes: ([0-9.]+)"
    get = lambda p, i: F.regexp_extract(value, p, i).try_cast("double")
    return lines.withColumns({"step_time": get(step, 1), "tflops": get(step, 2), "mem_gb": get(mem, 1)}).drop(value)
