"""Mixing sources to target weights.

Sizes are tokens of a public tokenizer.  Quotas are solved on the source
totals; each source then gives whole copies and part of one more, cut by a
hash order whose prefix sums are taken over hash buckets.  Copies are grouped
into blocks.  A splitting tree draws, by multivariate hypergeometric choice,
how many blocks of each source go to each output shard, so quotas are exact
over all shards; permuted blocks are then dealt disjointly and shards shuffled
locally.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .pii import permute

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Word pattern of that vocabulary (a fixed value of the public tokenizer).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_ROWS, SHARD_TOKENS = 64, 20_000_000
#: Hash buckets of a source's order: one for each thousand rows, between these numbers; their sums are broadcast.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 1_000, 4_096, 65_536
SEED = "threadloom-mix"


def source_key(col):
    """Case, outer blanks and blank versus underscore do not distinguish sources."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(col)), r"[\s_]+", "_"), F.lit(""))


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, tokens`` of whole texts; null and empty texts have none and are left out."""

    documents.sparkSession.sparkContext.addFile(tokenizer)  # executors need not have it in place
    name = os.path.basename(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken
        from pyspark import SparkFiles

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(SparkFiles.get(name), "rb"))}
        encoding = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "tokens": [len(encoding.encode_ordinary(t)) for t in batch["text"]]})

    rows = documents.where("text is not null and text <> '' and doc_id is not null").select("doc_id", source_key(F.col("source")).alias("source"), "text")
    return rows.where("source is not null").mapInPandas(run, "doc_id bigint, source string, tokens bigint").where("tokens > 0")


def solve_quotas(have: dict[str, int], target: dict[str, float], repeats: dict[str, int], total: int | None = None) -> dict[str, int]:
    """Tokens to take of each source.

    Without ``total`` it is the largest at which every source that has tokens
    reaches its share (targets of absent sources are spread over the others in
    proportion).  With a larger ``total``, sources that are used up give all
    they may and the rest is shared among the others, until consistent.
    """
    open_ = {s for s in target if have.get(s, 0) > 0 and target[s] > 0 and repeats.get(s, 1) > 0}
    if not open_:
        return {s: 0 for s in target}
    weight = sum(target[s] for s in open_)
    most = {s: have[s] * repeats.get(s, 1) for s in open_}
    if total is None:
        total = int(min(most[s] * weight / target[s] for s in open_))
    out = {s: 0 for s in target}
    left = total
    while open_:
        weight = sum(target[s] for s in open_)
        full = {s for s in open_ if left * target[s] / weight > most[s] + 0.5}
        if not full:
            for s in open_:
                out[s] = round(left * target[s] / weight)
            break
        for s in full:
            out[s] = most[s]
            left -= most[s]
        open_ -= full
    return out


def split_quotas(blocks: dict[str, int], shards: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Blocks of each source for each shard, by a tree of multivariate hypergeometric draws.

    The root holds all blocks; a node deals as many of its blocks to its left
    child as that child's shards hold, drawn without replacement.
    """
    names = sorted(blocks)
    rng = np.random.Generator(np.random.PCG64(seed))
    size = sum(blocks.values())
    bounds = [size * i // shards for i in range(shards + 1)]
    out = {s: np.zeros(shards, np.int64) for s in names}
    todo = [(0, shards, np.array([blocks[s] for s in names], np.int64))]
    while todo:
        lo, hi, counts = todo.pop()
        if hi - lo == 1:
            for s, n in zip(names, counts):
                out[s][lo] = n
            continue
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(counts, bounds[mid] - bounds[lo], method="marginals") if counts.sum() else counts * 0
        todo += [(lo, mid, left), (mid, hi, counts - left)]
    return out


def permuted(index: int, size: int, key: bytes) -> int:
    """Keyed permutation of 0 ... size-1: a Feistel network over the next square, walked until inside."""
    side = 1
    while side * side < size:
        side += 1
    while True:
        index = permute(index, side, side, key)
        if index < size:
            return index


def mix(documents: DataFrame, targets: DataFrame, *, tokenizer: str = TOKENIZER, total: int | None = None, shard_tokens: int = SHARD_TOKENS, scratch: Scratch | None = None) -> DataFrame:
    """The mixed corpus: ``shard, position, source, doc_id, copy, tokens``.

    ``documents``: ``doc_id, text, source``; ``targets``: ``source,
    target_share, max_repeats``.  Documents of other sources and without text
    take no part; a repeated document row counts as a document of its own
    share of copies.  Every copy number is below its source's ``max_repeats``.
    No documents or targets give an empty result.
    """
    spark = documents.sparkSession
    scratch = scratch or Scratch(spark, "mixing")
    rows = targets.where("source is not null").select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").collect()
    target = {r["source"]: float(r["target_share"] or 0) for r in rows}
    repeats = {r["source"]: int(r["max_repeats"] or 0) for r in rows}
    wanted = spark.createDataFrame([(s,) for s in target], "source string")
    counted = scratch.save(token_counts(documents, tokenizer).join(F.broadcast(wanted), "source", "left_semi"), "counted")
    have = {r["source"]: (r["t"], r["n"]) for r in counted.groupBy("source").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()}
    quota = solve_quotas({s: t for s, (t, _) in have.items()}, target, repeats, total)
    plan = [(s, quota[s] // t, quota[s] - quota[s] // t * t) for s, (t, _) in have.items()]
    planned = F.broadcast(spark.createDataFrame(plan, "source string, full bigint, part bigint"))

    # prefix sums in hash order: over buckets first, then inside the one bucket the cut falls into
    rows_ = sum(n for _, n in have.values())
    buckets = max(LEAST_BUCKETS, min(MOST_BUCKETS, rows_ // BUCKET_ROWS))
    place = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("tokens"))
    placed = counted.join(planned, "source").withColumn("place", place).withColumn("bucket", F.pmod("place", F.lit(buckets)))
    sums = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))  # as many rows as buckets for each source
    placed = placed.join(F.broadcast(sums), ["source", "bucket"])
    # the nearest cut: a document is in when its middle is
    inside = Window.partitionBy("source", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.where("before < part and before + sum > part").withColumn("up_to", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    cut = edge.where(F.col("up_to") + F.col("tokens") / 2 <= F.col("part"))
    extra = placed.where("before + sum <= part").unionByName(cut.drop("up_to")).select("source", "doc_id", "tokens", F.col("full").alias("copy"))
    whole = placed.where("full > 0").select("source", "doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("copy"))
    copies = scratch.save(whole.unionByName(extra), "copies")

    sizes = {r["source"]: (r["n"], r["t"]) for r in copies.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()}
    blocks = {s: max(1, n // BLOCK_ROWS) for s, (n, _) in sizes.items()}
    shards = max(1, min(sum(blocks.values()) or 1, -(-sum(t for _, t in sizes.values()) // shard_tokens)))
    ends = {s: np.cumsum(q) for s, q in split_quotas(blocks, shards).items()}
    keys = {s: (SEED + s).encode()[:64] for s in blocks}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[str, int], int] = {}
        for batch in batches:
            out = []
            for s, h in zip(batch["source"], batch["h"]):
                b = h % blocks[s]
                if (s, b) not in known:
                    known[s, b] = int(np.searchsorted(ends[s], permuted(b, blocks[s], keys[s]), side="right"))
                out.append(known[s, b])
            batch["shard"] = out
            yield batch.drop(columns="h")

    hashed = copies.withColumn("h", F.xxhash64(F.lit(SEED + "-block"), "doc_id", "copy", "tokens"))
    dealt = hashed.mapInPandas(deal, "source string, doc_id bigint, tokens bigint, copy bigint, shard int")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(SEED + "-order"), "doc_id", "copy"), "doc_id", "copy")
    return dealt.withColumn("position", F.row_number().over(local)).select("shard", "position", "source", "doc_id", F.col("copy").cast("int").alias("copy"), "tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and actual share, tokens and documents of each source of the targets."""
    used = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"), (F.max("copy") + 1).alias("repeats"))
    total = Window.partitionBy()
    wanted = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats")
    out = wanted.join(used, "source", "left").fillna(0, ["tokens", "documents", "repeats"])
    return out.withColumn("share", F.round(F.col("tokens") / F.greatest(F.sum("tokens").over(total), F.lit(1)), 6)).select(
        "source", "target_share", "share", "tokens", "documents", "repeats", "max_repeats"
    )
