"""A mergeable sidecar of accepted line hashes: bitmaps that say which rows of a feed can be replays.

Every load stores, for each source and period, bitmaps of its rows' hashes. Asking them costs no stored row; only rows
whose bit is set meet stored hashes afterwards. A bitmap has false hits and no false misses, so the answer of the
anti-join stays the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits for each stored row: one row in so many that is not there has its bit set all the same.
SPARSITY = 16
#: Bits of one stored bitmap, as Spark's bitmap functions have them.
BUCKET_BITS = 15
#: More than 2**40 bits for one load, source and period are not used; the sidecar gets denser then.
MOST_BITS = 40

SIDECAR = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("bits", T.IntegerType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bitmap", T.BinaryType()),
        T.StructField("posted_period", T.DateType()),
    ]
)
KEY = ["source_name", "posted_period", "bits", "bucket"]


def _placed(rows: DataFrame) -> DataFrame:
    """Add bucket and place of each row's bit; ``bits`` is the logarithm of the number of bits.

    A bit follows the text of the hash, also where the rows have its bytes.
    """
    spelled = "raw_line_hash" if dict(rows.dtypes)["raw_line_hash"] == "string" else "lower(hex(raw_line_hash))"
    at = F.expr(f"pmod(xxhash64({spelled}), shiftleft(1L, bits))")
    return rows.withColumn("at", at).select(
        "*", F.shiftright("at", BUCKET_BITS).alias("bucket"), (F.col("at") % 2**BUCKET_BITS).alias("place")
    )


def bitmaps(accepted: DataFrame) -> DataFrame:
    """``SIDECAR`` rows of accepted rows (source_name, posted_period, raw_line_hash).

    The number of bits follows the rows of each source and period, so a bitmap is as dense for a busy day as for a quiet
    one. The counts, a row for each source and period, go to all tasks. Places are shuffled and not bitmaps set in
    parts: every task has rows of almost every bucket, so the parts would grow with the square of the rows. A bucket gets
    about 2,048 rows (its bits by ``SPARSITY``), so a busy source is spread over its buckets.
    """
    sizes = accepted.groupBy("source_name", "posted_period").agg(F.count(F.lit(1)).alias("n"))
    exponent = F.ceil(F.log2(F.col("n") * SPARSITY)).cast("int")
    bits = F.least(F.greatest(exponent, F.lit(BUCKET_BITS)), F.lit(MOST_BITS))
    known = F.broadcast(sizes.select("source_name", "posted_period", bits.alias("bits")))
    places = _placed(accepted.join(known, ["source_name", "posted_period"])).select(*KEY, "place").repartition(*KEY)
    made = places.groupBy(*KEY).agg(F.bitmap_construct_agg("place").alias("bitmap"))
    return made.select(SIDECAR.fieldNames())


def merged(sidecar: DataFrame) -> DataFrame:
    """One bitmap for each key: those of several loads put together."""
    return sidecar.groupBy(*KEY).agg(F.bitmap_or_agg("bitmap").alias("bitmap")).select(SIDECAR.fieldNames())


def possible_replays(rows: DataFrame, sidecar: DataFrame) -> DataFrame:
    """raw_line_hash, source_name and due_period of the rows whose bit a load has set in their source and period.

    The hash may be text or bytes and comes back as it was.
    """
    there = sidecar.select("source_name", "posted_period", "bits").distinct()
    asked = rows.select("raw_line_hash", "source_name", F.col("due_period").alias("posted_period"))
    probes = _placed(asked.join(F.broadcast(there), ["source_name", "posted_period"])).drop("at")
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(F.col("place") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, cast(place % 8 as int)) & 1 = 1")
    return (
        probes.join(merged(sidecar), KEY)
        .withColumn("byte", byte)
        .where(hit)
        .select("raw_line_hash", "source_name", F.col("posted_period").alias("due_period"))
        .distinct()
    )
