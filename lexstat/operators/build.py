"""Merging weighted counts of several inputs, frequency buckets, overlays, component entries, partner types, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lowest count of buckets 1 to 5; bucket 6 is reserved, 7 holds headwords and titles.
BUCKET_FLOORS = (3, 10, 100, 1000, 10000)
HEADWORD_BUCKET = 7
#: Default weights of the counted inputs.
WEIGHTS = {"wiki": 1.0, "docs": 2.0, "corpus": 2.0}


def bucket_of(count: Column, min_count: int = 3) -> Column:
    """1 to 5 by the floors, null below min_count (which must be at least the first floor)."""
    if min_count < BUCKET_FLOORS[0]:
        raise ValueError(f"min_count must be at least {BUCKET_FLOORS[0]}")
    out = F.when(count < min_count, F.lit(None).cast("int"))
    for b, floor in reversed(list(enumerate(BUCKET_FLOORS, 1))):
        out = out.when(count >= floor, b)
    return out


def bucket_ranges(spark: SparkSession) -> DataFrame:
    """bucket, low, high: contiguous ranges, the last without high."""
    rows = [(i + 1, lo, BUCKET_FLOORS[i + 1] - 1 if i + 1 < len(BUCKET_FLOORS) else None) for i, lo in enumerate(BUCKET_FLOORS)]
    return spark.createDataFrame(rows, "bucket int, low bigint, high bigint")


def weighted_union(counts: DataFrame, weights: dict[str, float] = WEIGHTS, key: str = "key") -> DataFrame:
    """key, cnt: counts (input, key, cnt) of all inputs by weight, rounded half up; a missing input counts 0.

    One shuffle with map-side sums, however many inputs. Inputs without a weight and null keys or counts are left out;
    sums per input are exact, only the weighting is in doubles.
    """
    for w in weights.values():
        if not 0 <= w < float("inf"):
            raise ValueError("weights must be finite and not negative")
    names = sorted(weights)
    d = counts.where(F.col(key).isNotNull() & F.col("cnt").isNotNull() & F.col("input").isin(names))
    sums = d.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("input") == n, F.col("cnt"))), F.lit(0)).alias(f"_{n}") for n in names])
    total = sum((F.col(f"_{n}") * F.lit(float(weights[n])) for n in names), F.lit(0.0))
    return sums.select(key, F.floor(total + 0.5).cast("bigint").alias("cnt"))


def bucketed(counts: DataFrame, min_count: int = 3, key: str = "key") -> DataFrame:
    return counts.select(key, bucket_of(F.col("cnt"), min_count).alias("bucket")).where("bucket is not null")


def overlay(buckets: DataFrame, headwords: DataFrame, key: str = "key") -> DataFrame:
    """key, bucket: the larger bucket of counted keys and headwords (key), which have bucket 7."""
    h = headwords.where(F.col(key).isNotNull()).select(key, F.lit(HEADWORD_BUCKET).alias("bucket"))
    return buckets.unionByName(h).groupBy(key).agg(F.max("bucket").alias("bucket"))


def components(frequencies: DataFrame, partners: DataFrame, min_count: int = 3) -> DataFrame:
    """part, frequency and partner counts of parts with frequency >= min_count, and of long-unit parts without a frequency (0).

    frequencies: part, cnt; partners: part, prefix_foreign, prefix_kango, suffix_foreign, suffix_kango, is_long.
    """
    cols = ["prefix_foreign", "prefix_kango", "suffix_foreign", "suffix_kango"]
    kept = frequencies.where(F.col("cnt") >= min_count).select("part", F.col("cnt").alias("frequency"))
    have = kept.join(partners, "part", "left").select("part", "frequency", *[F.coalesce(c, F.lit(0)).alias(c) for c in cols])
    long = partners.where("is_long").join(kept.select("part"), "part", "left_anti").select("part", F.lit(0).cast("bigint").alias("frequency"), *cols)
    return have.unionByName(long)


def partner_kind(surface: Column) -> Column:
    """foreign (Latin or katakana throughout), kango (holds a kanji), else null."""
    return F.when(surface.rlike("^[A-Za-zァ-ヺー]+$"), "foreign").when(surface.rlike("[一-鿿々]"), "kango")


def partner_counts(compounds: DataFrame) -> DataFrame:
    """part, prefix_foreign, prefix_kango, suffix_foreign, suffix_kango: compounds in which the part has such a neighbour.

    compounds: compound, surfaces. A prefix partner stands before the part, a suffix partner after; each compound counts
    once per part, side and kind. Parts without any counted partner are left out.
    """
    d = compounds.where(F.size("surfaces") >= 2).select("compound", "surfaces")
    i = F.sequence(F.lit(1), F.size("surfaces") - 1)
    row = lambda part, side, other: F.struct(part.alias("part"), F.lit(side).alias("side"), partner_kind(other).alias("kind"))
    both = F.flatten(F.transform(i, lambda k: F.array(
        row(F.element_at("surfaces", k + 1), "prefix", F.element_at("surfaces", k)), row(F.element_at("surfaces", k), "suffix", F.element_at("surfaces", k + 1)))))
    x = d.select("compound", F.explode(F.array_distinct(both)).alias("x")).select("x.*").where("kind is not null")
    count = lambda s, k: F.count_if((F.col("side") == s) & (F.col("kind") == k)).alias(f"{s}_{k}")
    return x.groupBy("part").agg(*[count(s, k) for s in ("prefix", "suffix") for k in ("foreign", "kango")])


def encode_frequency(n: Column) -> Column:
    """11 bits: exact to 1023, then 16 steps per doubling, at most 2047."""
    return F.when(n <= 1023, n).otherwise(F.least(F.lit(2047), 1024 + F.floor(16 * F.log2(n / 1024.0)))).cast("bigint")


def decode_frequency(code: Column) -> Column:
    """The lowest count with this code."""
    return F.when(code <= 1023, code).otherwise(F.ceil(1024 * F.pow(F.lit(2.0), (code - 1024) / 16.0) - 1e-9)).cast("bigint")


def encode_partner(n: Column) -> Column:
    """8 bits: exact to 127, then 8 steps per doubling, at most 255."""
    return F.when(n <= 127, n).otherwise(F.least(F.lit(255), 128 + F.floor(8 * F.log2(n / 128.0)))).cast("bigint")


def packed(frequency: Column, partners: list[Column]) -> Column:
    """One 64-bit value: version bit 61, frequency code from bit 0, the four partner codes from bits 11, 19, 27 and 35."""
    out = F.lit(1 << 61).bitwiseOR(encode_frequency(frequency))
    for at, p in zip((11, 19, 27, 35), partners):
        out = out.bitwiseOR(F.shiftleft(encode_partner(p), at))
    return out


def unpacked(value: Column) -> dict[str, Column]:
    """The codes in a packed value, by name."""
    take = lambda at, bits: F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << bits) - 1))
    return {"frequency": take(0, 11), "prefix_foreign": take(11, 8), "prefix_kango": take(19, 8), "suffix_foreign": take(27, 8), "suffix_kango": take(35, 8)}


def merged_runs(lines: DataFrame, key: str = "term") -> DataFrame:
    """key, cnt: sorted runs merged into one table of sums; ordering the result by key range-partitions it.

    lines: run_id, line_no, key, cnt; a line delivered twice counts once, lines with a null key or count do not.
    """
    d = lines.where(F.col(key).isNotNull() & F.col("cnt").isNotNull()).dropDuplicates(["run_id", "line_no"])
    return d.groupBy(key).agg(F.sum("cnt").alias("cnt"))


def check_inputs(inputs: dict[str, dict], weights: dict[str, float], min_count: int) -> None:
    """Raises unless weights are finite and not negative, min_count is at least 3, all inputs were counted with the same
    setting for unknown words, and all or none have domain counts. inputs: name to its stats (unknown, domains)."""
    for w in weights.values():
        if not 0 <= w < float("inf"):
            raise ValueError("weights must be finite and not negative")
    if min_count < BUCKET_FLOORS[0]:
        raise ValueError(f"min_count must be at least {BUCKET_FLOORS[0]}")
    for what in ("unknown", "domains"):
        if len({bool(x.get(what)) for x in inputs.values()}) > 1:
            raise ValueError(f"the inputs differ in {what}")


def digest(table: DataFrame) -> str:
    """A hash of a table's rows that their order does not change: the sum of 64-bit row hashes, and the number of rows."""
    s, n = table.agg(F.sum(F.xxhash64(*sorted(table.columns)).cast("decimal(20,0)")), F.count(F.lit(1))).first()
    return f"{int(s or 0) % 2**64:016x}-{n}"


def manifest(buckets: DataFrame, parts: DataFrame, weights: dict[str, float] = WEIGHTS, version: str = "") -> dict:
    """What a release says of itself: version, weights, bucket ranges and key counts per bucket (at most seven groups)."""
    per = {r["bucket"]: r["n"] for r in buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"version": version, "weights": dict(weights), "buckets": [{"bucket": i + 1, "low": lo, "keys": per.get(i + 1, 0)} for i, lo in enumerate(BUCKET_FLOORS)]
            + [{"bucket": HEADWORD_BUCKET, "low": None, "keys": per.get(HEADWORD_BUCKET, 0)}], "components": parts.count(),
            "digests": {"buckets": digest(buckets), "components": digest(parts)}}
