"""A global random order in shards, by a two-pass external shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.common import fresh, name, without
from offerlens.session import new_path, stage

BUCKET_BYTES = 8 << 20
SEED = 11


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text, 0 for NULL."""
    return F.coalesce(F.octet_length(name(text)), F.lit(0)).cast("long")


def write_shards(docs: DataFrame, shards: int, path: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                 key: str = "doc_id") -> DataFrame:
    """Write ``docs`` in random order as ``shards`` folders of ``path`` and read them back with shard and slot.

    First pass: a seeded hash of the key scatters rows uniformly into buckets
    of about ``bucket_bytes``. Second pass: each bucket is put in hash order,
    shuffled by Fisher-Yates with a generator of its own, and written. The row at global
    place r goes to shard r * shards // n, so counts differ by one at most,
    and slot counts from 0 within the shard. Files hold rows in slot order.

    A bucket far beyond its size holds a repeated key: its rows are dealt to
    several parts by a number written down with a copy of the table, so
    repeated rows, and NULL keys, spread as well. The order then depends on how
    the table was read; else it depends on the seed and the rows only. Input
    columns named shard or slot are replaced. An empty table gives no rows.
    """
    source = without(docs, ("shard", "slot"))
    size = text_bytes() + F.lit(8)
    n, total = source.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    bucket, part, first, order, salt, rank = (fresh(source, f"_{stem}") for stem in ("bucket", "part", "first", "order", "salt", "rank"))
    hashed = F.pmod(F.xxhash64(F.lit(seed), name(key)), F.lit(buckets))
    sizes = source.groupBy(hashed.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"), F.max(size).alias("largest"))
    hot = [(r["b"], -(-r["bytes"] // bucket_bytes)) for r in sizes.where(
        (F.col("n") > 1) & (F.col("bytes") - F.col("largest") > 3 * bucket_bytes)).collect()]
    if hot:
        source = stage(source.withColumn(salt, F.monotonically_increasing_id()), "salted")
        parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in hot for x in pair]), hashed), F.lit(1))
        dealt = F.pmod(F.xxhash64(F.lit(seed + 1), name(salt)), parts).cast("int")
    else:
        dealt = F.lit(0)
    keyed = source.withColumns({bucket: hashed, part: dealt})
    counts = keyed.groupBy(bucket, part).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(bucket, part).rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(counts.select(bucket, part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(first)), "starts")
    columns = [c for c in source.columns if c != salt]
    plain = [f"c{i}" for i in range(len(columns))]  # Arrow functions take no dots in names
    placed = keyed.join(starts, [bucket, part]).select(
        *[name(c).alias(p) for c, p in zip(columns, plain)], bucket, part, first, F.xxhash64(F.lit(seed), *[_hashable(source, c) for c in source.columns]).alias(order))

    def shuffled(group: pa.Table) -> pa.Table:
        at = group.num_columns - 4
        by_hash = pc.sort_indices(group, sort_keys=[(order, "ascending")])
        draw = np.random.default_rng([seed, group.column(at)[0].as_py(), group.column(at + 1)[0].as_py()])
        swapped = np.arange(group.num_rows)
        draw.shuffle(swapped)  # Fisher-Yates
        start = group.column(at + 2)[0].as_py()
        return pa.Table.from_arrays(
            [*group.select(range(at)).take(by_hash.take(pa.array(swapped))).columns, pa.array(np.arange(start, start + group.num_rows))],
            names=[*group.column_names[:at], rank])

    schema = placed.select(*plain).schema.add(rank, "long")
    ranked = placed.groupBy(bucket, part).applyInArrow(shuffled, schema).select(
        *[name(p).alias(c) for c, p in zip(columns, plain)], rank)
    shard = F.expr(f"`{rank}` * {shards} div {max(n, 1)}")
    out = ranked.withColumn("shard", shard.cast("int")).withColumn(
        "slot", name(rank) - F.expr(f"(shard * {n} + {shards - 1}) div {shards}")).drop(rank)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def _hashable(docs: DataFrame, column: str) -> Column:
    """A column xxhash64 takes: maps go as their sorted entries in JSON."""
    return F.to_json(name(column)) if docs.schema[column].dataType.typeName() in ("map", "variant") else name(column)


def shards_of(docs: DataFrame, shards: int, **options) -> DataFrame:
    """``write_shards`` to a new folder of the shared place."""
    return write_shards(docs, shards, new_path(docs.sparkSession, "shards"), **options)


def digest(sharded: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of written shards."""
    return sharded.select(
        name("doc_id").alias("doc_id"), (text_bytes() + F.lit(8)).alias("size"),
        F.crc32(F.coalesce(name("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
