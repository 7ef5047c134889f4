"""Sharding by rendezvous hashing.

Each record has a pseudo-random number for each shard, drawn from its key and the shard alone; the record goes where the
number, scaled by the weight of the shard, comes first. With one more shard the others keep their numbers, so a record
stays or moves into the new shard, in proportion to its weight.

The numbers are digits of SHA-256 values of the key: the same on any engine and at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import quoted, written
from tallycube.operators.reshape import running_total

SHARDS = 16
DIGITS = 13  # hexadecimal digits of a number: 52 bits, which a double holds exactly
IN_HASH = 4  # numbers in one hash
COPIES = 1000  # equal rows that are numbered as one

LAW = "key"


def draws(key: Column, shards: int) -> list[Column]:
    """A number between 0 and 1 for each shard."""
    hashes = [F.sha2(F.concat_ws("/", key, F.lit(str(k))), 256) for k in range(-(-shards // IN_HASH))]
    return [
        (F.conv(F.substring(hashes[j // IN_HASH], 1 + DIGITS * (j % IN_HASH), DIGITS), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**DIGITS))
        for j in range(shards)
    ]


def shard_of(races: Column, weights: Sequence[float]) -> Column:
    """The winner among the first len(weights) shards: the smallest exponential waiting time, the first of equal ones.

    A shard of weight 0 gets nothing.
    """
    times = F.array(*[-F.log(races[j]) / F.lit(float(w)) if w > 0 else F.lit(float("inf")) for j, w in enumerate(weights)])
    return (F.array_position(times, F.array_min(times)) - 1).cast("int")


def place(
    documents: DataFrame,
    weights: Sequence[float] = (1.0,) * SHARDS,
    added_weight: float = 1.0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `size` is the number of UTF-8 bytes of the text and one more; a null text has no bytes. The key is `doc_id`: rows
    with the same id, and those without one, share a shard. `slot` numbers the rows of a shard without gaps from 0, by
    doc_id (null first), size and checksum; rows equal in these get one slot each, in no order of their own.
    `grown_shard` is the shard if one more of `added_weight` stood behind the others. Other columns are left out, also
    those named like an output; an empty table gives no rows.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights are numbers of at least 0, one of them above 0")
    key = F.coalesce(quoted(doc_id).cast("string"), F.lit(""))
    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    facts = documents.select(
        quoted(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
        F.array(*draws(key, len(weights) + 1)).alias("races"),
    )
    grown = [*weights, added_weight]
    rows = written(
        facts.select("doc_id", "size", "text_crc32", shard_of(F.col("races"), weights).alias("shard"), shard_of(F.col("races"), grown).alias("grown_shard")),
        "placed",
    )
    # Equal rows are counted first and numbered in blocks, so that many copies of one row spread over the ranges.
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))))
    blocks = blocks.withColumn("n", F.least(F.lit(COPIES), F.col("n") - COPIES * F.col("block")))
    numbered = running_total(blocks, ["shard", "doc_id", "size", "text_crc32", "block"], "at", "n")
    # One row for each shard.
    filled = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).select(F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("f"))
    before = F.aggregate(F.filter("f", lambda x: x["shard"] < F.col("shard")), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    starts = rows.select("shard").distinct().join(F.broadcast(filled)).select("shard", before.alias("before"))
    slots = numbered.join(F.broadcast(starts), "shard").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("at") - F.col("before") + F.col("copy")).alias("slot"), "grown_shard"
    )
