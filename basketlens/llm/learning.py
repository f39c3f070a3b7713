"""Shared parts of the text classifiers: the labelled sample, training rounds, scoring."""

from __future__ import annotations

import io
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.shipping import by_value
from basketlens.session import Scratch

by_value(__name__)

SLICES = 16  # of a model, averaged separately
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """One 64-bit hash from two, by position."""
    x = (a ^ (a >> np.uint64(29))) * MIX + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: CRC-32 of the number as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id``, ``label`` of at most ``most`` documents to learn from, chosen by a hash of their number.

    Null labels and numbers are left out; a document with several labels has the larger.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def feature_rows(
    docs: DataFrame, sample: DataFrame, features: Callable[[bytes], tuple[np.ndarray, np.ndarray]], scratch: Scratch, shards: int
) -> DataFrame:
    """``shard``, ``doc_id``, ``label``, ``idx``, ``val`` of the sampled documents, written once."""

    def run(batches):
        for batch in batches:
            made = [features(t or b"") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.float32()))],
                ["doc_id", "label", "idx", "val"],
            )

    # The sample has a fixed bound (some 12 bytes for each of at most ``most`` rows), so it may be broadcast.
    sample = scratch.write(sample, "sample")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    rows = texts.mapInArrow(run, "doc_id long, label int, idx array<int>, val array<float>")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int"))
    return scratch.write(rows.repartition(shards, "shard"), "features")


def packed_shards(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``shard``, ``examples``: every shard as one value, written once, so that a round is a map over a few bounded rows."""

    def pack(table: pa.Table) -> pa.Table:
        out = io.BytesIO()
        with pa.ipc.new_stream(out, table.schema) as sink:
            sink.write_table(table)
        return pa.table({"shard": table.column("shard")[:1], "examples": pa.array([zstandard.compress(out.getvalue())], pa.binary())})

    packed = rows.select("shard", "doc_id", "label", "idx", "val").groupBy("shard").applyInArrow(pack, "shard int, examples binary")
    return scratch.write(packed, "shards")


def _unpacked(examples: bytes) -> list[tuple]:
    table = pa.ipc.open_stream(zstandard.decompress(examples)).read_all().combine_chunks()
    lists = []
    for name in ("idx", "val"):
        column = table.column(name).combine_chunks()
        values, edges = column.flatten().to_numpy(), column.offsets.to_numpy()
        lists.append([values[a:b] for a, b in zip(edges - edges[0], edges[1:] - edges[0])])
    return list(zip(table.column("doc_id").to_pylist(), table.column("label").to_pylist(), *lists))


def train_rounds(
    rows: DataFrame, start: dict[str, np.ndarray], learn: Callable[[dict, list, int], dict], rounds: int, scratch: Scratch
) -> dict[str, np.ndarray]:
    """Iterative parameter mixing: in each round every shard learns from the mean of the last round, in a task of its own.

    A shard sends back what it changed alone: the numbers of the coordinates (rows of a parameter) and their new values.  What
    it did not change it holds as it was sent, so the mean over all shards needs no more.  The mean is taken slice by
    slice in Spark, and the driver gets one model of fixed size, whatever the number of shards.  Rows are taken in the order of a hash of their number
    and the round: retried tasks and reruns agree.
    """
    packed = packed_shards(rows, scratch)
    shards = packed.count()
    model = start
    for at in range(rounds if shards else 0):
        sent = rows.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in model.items()})

        def run(batches):
            for batch in batches:
                for examples in batch.column(1).to_pylist():
                    found = sorted(_unpacked(examples), key=lambda e: (zlib.crc32(f"{e[0]}:{at}".encode()), e[0]))
                    given = {k: v.astype(np.float64) for k, v in sent.value.items()}
                    out = learn(given, [(idx, val.astype(np.float64), int(label)) for _, label, idx, val in found], at)
                    parts = []
                    for name, old in sent.value.items():
                        new = out[name].astype(np.float32)
                        changed = np.flatnonzero((new != old).reshape(len(old), -1).any(axis=1)).astype(np.int32)
                        edges = np.searchsorted(changed, np.linspace(0, len(old), SLICES + 1)[1:-1])
                        parts += [(k, name, c.tobytes(), new[c].tobytes()) for k, c in enumerate(np.split(changed, edges)) if len(c)]
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*parts), (pa.int32(), pa.string(), pa.binary(), pa.binary()))]
                                                     if parts else [pa.array([], k) for k in (pa.int32(), pa.string(), pa.binary(), pa.binary())], ["slice", "name", "which", "new"])

        def mean(table: pa.Table) -> pa.Table:
            name = table.column("name")[0].as_py()
            old = sent.value[name]
            total = np.zeros(old.shape)
            touched = np.zeros(len(old), dtype=bool)
            # The order of sums must not depend on the order of arrival.
            for which, new in sorted(zip(table.column("which").to_pylist(), table.column("new").to_pylist())):
                which = np.frombuffer(which, dtype=np.int32)
                total[which] += np.frombuffer(new, dtype=np.float32).reshape(len(which), *old.shape[1:]).astype(np.float64) - old[which]
                touched[which] = True
            which = np.flatnonzero(touched).astype(np.int32)
            new = (old[which] + total[which] / shards).astype(np.float32)
            return pa.table({"name": [name], "which": [which.tobytes()], "new": [new.tobytes()]})

        learned = packed.mapInArrow(run, "slice int, name string, which binary, new binary")
        got = learned.groupBy("slice", "name").applyInArrow(mean, "name string, which binary, new binary").collect()
        model = {k: v.astype(np.float32) for k, v in model.items()}
        for r in got:
            which = np.frombuffer(r["which"], dtype=np.int32)
            model[r["name"]][which] = np.frombuffer(r["new"], dtype=np.float32).reshape(len(which), *start[r["name"]].shape[1:])
        model = {k: v.astype(np.float64) for k, v in model.items()}
        sent.destroy()
    return model


def score_documents(
    docs: DataFrame, model: dict[str, np.ndarray], features: Callable[[bytes], tuple[np.ndarray, np.ndarray]],
    margin: Callable[[dict, np.ndarray, np.ndarray], float], threshold: float,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` per input row.  The model, of fixed size, is broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            z = np.array([margin(sent.value, *features(t or b"")) for t in batch.column(1).to_pylist()], dtype=np.float64)
            score = 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
