"""Deduplicating new batches against all history.

*Bands.*  A record is a few sets of features, one per band: a band of a fingerprint
record has one feature, the scoped key (hash digits, with the architecture where the
key is architecture-bound, or the task id); a band may also name an array column.
The minwise key of a band is the smallest 64-bit hash over its features; the
*signature* of a record holds, for each band, 32 bits of another hash of that
smallest feature (0: empty band).  Records that agree in a band meet in its bucket;
the share of bands in which two signatures agree is their *similarity*.  For bands of
one feature that is exact but for chance equality of 96 bits; for larger sets two
records of likeness J agree in a band with probability J.

*Index.*  Unique band keys ``(bucket, band, minwise, check, first_id, signature)``, the
signature being that of the first bringer and ``check`` its bits for the band, in
files partitioned by ``bucket`` (minwise key modulo the number of buckets) and sorted
by minwise key.  The text of the keys is not kept.  Every append is a generation of its
own, listed in a numbered manifest in the index folder, so another session opens the
index by its path and neither reads the history nor rewrites it.  Generations of
similar size are merged, so there are as many as the logarithm of the rows; merged ones
stay for sessions that still read them until ``vacuum``.

*Probe.*  Only the buckets that the batch's keys fall into are read; a key is held if
its bits of the signature agree, too.

A record brings nothing new if one of its keys is in the history, or was brought
by a record of lower id in the same submission.  Keys are added whatever the
verdict of their record, hence the verdict of many batches at once equals that of
one batch after another, and "the first bringer of a key" is a plain minimum:
records are reduced to unique keys (combined on the map side) before anything is
joined, so a key that a third of all rows share is one row in every join.

Defined cases: null, blank and malformed hashes are no keys; a record without any
key is new; rows sent twice under one id are one record with the keys of both (and the
smaller signature); equal ids in different batches are one record; empty history or
batches are allowed; other columns of the inputs are not touched.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.plans.files import list_files, make_file, read_text
from quern.plans.stage import Stage

#: Bands in the order of the signature: column, whether the key is bound to the architecture.
BANDS = (("prompt_hash", True), ("assistant_ast_hash", True), ("semantic_hash", False), ("reference_ast_hash", False), ("task_id", False))
DEFAULT_ARCHITECTURE = "blackwell"
ROWS_PER_BUCKET = 500_000
LEAST_BUCKETS = 16
#: A generation is merged with the one before unless that has this many times its rows.
GROWTH = 4
#: More buckets than this are not listed in the filter of a probe.
LISTED = 2000
_KEY = ["band", "minwise", "check"]
_INDEX = "band int, minwise long, check int, first_id long, signature array<int>, bucket int"


def _digits(c: str) -> Column:
    return F.nullif(F.regexp_extract(F.lower(c), "([0-9a-f]{64})", 1), F.lit(""))


def _features(rows: DataFrame, name: str, bound: bool) -> Column:
    """The features of a band; null or empty: none."""
    if rows.schema[name].dataType.typeName() == "array":
        return F.col(name).cast("array<string>")
    value = clean_key(name) if name == "task_id" else _digits(name)
    arch = F.coalesce(clean_key("gpu_architecture"), F.lit(DEFAULT_ARCHITECTURE))
    key = F.concat_ws(":", arch, value) if bound else value
    return F.when(value.isNotNull(), F.array(key))


def record_keys(rows: DataFrame, id_col: str, bands: tuple = BANDS, places: tuple[int, ...] | None = None) -> DataFrame:
    """Unique keys of records: ``id, band, minwise, check, signature``.

    ``places`` are the bands' places in the signature where ``bands`` are some of those of the index only.
    """
    places = places or tuple(range(len(bands)))
    least = {}
    for place, (name, bound) in zip(places, bands):
        hashed = F.transform(F.filter(_features(rows, name, bound), lambda x: x.isNotNull()), lambda x: F.struct(F.xxhash64(F.lit(place), x).alias("minwise"), F.hash(x, F.lit(place)).alias("check")))
        least[place] = F.array_min(hashed)
    none = F.lit(None).cast("struct<minwise:bigint,check:int>")
    out = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.array(*[least.get(i, none) for i in range(max(places) + 1)]).alias("all"))
    bits = F.transform("all", lambda x: F.when(x.isNull(), 0).otherwise(F.when(x.check == 0, 1).otherwise(x.check)))
    out = out.select("id", "all", bits.alias("signature")).select("id", "signature", F.posexplode("all").alias("band", "k")).where("k is not null")
    out = out.select("id", "band", "k.minwise", F.get("signature", "band").alias("check"), "signature")
    return out.groupBy("id", *_KEY).agg(F.min("signature").alias("signature"))


def similarity(a: Column, b: Column) -> Column:
    """Bands in which two signatures agree, over the bands that either fills."""
    both = F.arrays_zip(a.alias("x"), b.alias("y"))
    same = F.size(F.filter(both, lambda z: (z.x == z.y) & (z.x != 0)))
    filled = F.size(F.filter(both, lambda z: (F.coalesce(z.x, F.lit(0)) != 0) | (F.coalesce(z.y, F.lit(0)) != 0)))
    return F.try_divide(same, filled)


class HistoryIndex:
    """Persistent band keys of everything accepted; opens what stands under ``path``, or starts anew.

    Without a path the index gets a folder of its own in the shared folder.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.rows_per_bucket = spark, rows_per_bucket
        self.stage = Stage(spark, "history")
        self.path = path or f"{self.stage.path}/index"
        versions = sorted(f for f in list_files(spark, self.path) if f.startswith("manifest-"))
        self.version = int(versions[-1][9:-5]) if versions else 0
        self.generations: list[dict] = json.loads(read_text(spark, f"{self.path}/{versions[-1]}"))["generations"] if versions else []

    def _publish(self, generations: list[dict]) -> None:
        """Make these the generations, by the next manifest; fails if another session was first."""
        self.version += 1
        make_file(self.spark, f"{self.path}/manifest-{self.version:08d}.json", json.dumps({"generations": generations}))
        self.generations = generations

    def _write(self, unique: DataFrame, rows: int) -> dict:
        """A table of unique keys as files by bucket."""
        buckets = max(LEAST_BUCKETS, 1 << (rows // self.rows_per_bucket).bit_length())
        folder = f"{self.path}/generation-{self.version + 1:08d}-{uuid.uuid4().hex}"  # another session may write the same number
        placed = unique.withColumn("bucket", F.pmod("minwise", F.lit(buckets)).cast("int"))
        placed.repartition("bucket").sortWithinPartitions("bucket", "minwise").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return {"folder": folder, "buckets": buckets, "rows": rows}

    def _read(self, g: dict) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(g["folder"])

    def append(self, keys: DataFrame) -> None:
        """Add keys (id, band, minwise, check, signature) as a new generation; only the first bringer of a key is kept."""
        unique = self.stage.write(keys.groupBy(*_KEY).agg(F.min("id").alias("first_id"), F.min_by("signature", "id").alias("signature")))
        rows = unique.count()
        if not rows:
            return
        kept, merged = list(self.generations), unique
        while kept and kept[-1]["rows"] < GROWTH * rows:
            g = kept.pop()
            merged = merged.unionByName(self._read(g).drop("bucket"))
            rows += g["rows"]
        if merged is not unique:
            merged = self.stage.write(merged.groupBy(*_KEY).agg(F.min_by("signature", "first_id").alias("signature"), F.min("first_id").alias("first_id")))
            rows = merged.count()
        self._publish([*kept, self._write(merged, rows)])

    def vacuum(self) -> None:
        """Delete generations that the manifest no longer lists; only while no other session reads or appends."""
        listed = {g["folder"] for g in self.generations}
        self.stage.drop(*[p for f in list_files(self.spark, self.path) if f.startswith("generation-") and (p := f"{self.path}/{f}") not in listed] or [f"{self.path}/none"])

    def probe(self, keys: DataFrame) -> DataFrame:
        """Those of the unique keys (band, minwise, check) that the history holds, with first bringer and its signature."""
        found = []
        for g in self.generations:
            placed = keys.select(*_KEY, F.pmod("minwise", F.lit(g["buckets"])).cast("int").alias("bucket"))
            used = [r[0] for r in placed.select("bucket").distinct().limit(LISTED + 1).collect()]  # at most LISTED + 1 numbers
            part = self._read(g)
            if len(used) < min(g["buckets"], LISTED + 1):
                part = part.where(F.col("bucket").isin(used))
            found.append(placed.join(part, ["bucket", *_KEY]).select(*_KEY, "first_id", "signature"))
        if not found:
            return self.spark.createDataFrame([], _INDEX).drop("bucket")
        if len(found) == 1:
            return found[0]
        return reduce(DataFrame.unionByName, found).groupBy(*_KEY).agg(F.min_by("signature", "first_id").alias("signature"), F.min("first_id").alias("first_id"))


def submit(index: HistoryIndex, batch: DataFrame, id_col: str = "fp_id", append: bool = True, bands: tuple = BANDS) -> DataFrame:
    """Check a submission (one or many batches) against the history, then add its keys.

    Returns one row per record: id, keys (how many it has), brought (how many of
    them neither the history holds nor a record of lower id in this submission
    has), is_new (it brought all of them).
    """
    stage = index.stage
    keys = stage.write(record_keys(batch, id_col, bands))
    unique = stage.write(keys.groupBy(*_KEY).agg(F.min("id").alias("id"), F.min_by("signature", "id").alias("signature")))
    fresh = stage.write(unique.join(index.probe(unique), _KEY, "left_anti"))
    first = fresh.groupBy("id").agg(F.count("*").alias("brought"))
    total = keys.groupBy("id").agg(F.count("*").alias("keys"))
    out = batch.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    out = out.join(total, "id", "left").join(first, "id", "left").na.fill(0, ["keys", "brought"])
    out = stage.write(out.select("id", "keys", "brought", (F.col("keys") == F.col("brought")).alias("is_new")))
    if append:
        index.append(fresh)
    return out


def matches(index: HistoryIndex, batch: DataFrame, id_col: str = "fp_id", least: float = 0.0, bands: tuple = BANDS) -> DataFrame:
    """The most similar record of the history for each record: ``id, match_id, shared, similarity``.

    Candidates are the first bringers of the record's held keys; one row per record
    with a candidate of at least the similarity ``least`` (of equal ones the lowest id);
    shared counts the held keys.  The history is not changed.
    """
    keys = index.stage.write(record_keys(batch, id_col, bands))
    held = index.probe(keys.select(*_KEY).distinct()).withColumnRenamed("signature", "theirs")
    both = keys.join(held, _KEY).withColumn("similarity", similarity(F.col("signature"), F.col("theirs")))
    best = both.groupBy("id").agg(F.count_distinct(*_KEY).alias("shared"), F.max(F.struct("similarity", (-F.col("first_id")).alias("m"))).alias("best"))
    return best.select("id", (-F.col("best.m")).alias("match_id"), "shared", "best.similarity").where(F.col("similarity") >= least)
