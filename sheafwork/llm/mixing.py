"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of source, language and topic, by their tokens (runs without white space). The
cells' token weights are raked until the weighted tokens meet the target of every source, every language and every
topic in turn; a document is then kept with the probability min(1, c * weight of its cell), where c makes the
expected tokens equal to a share of all tokens. Draws come from a hash of the id, so a run repeats exactly.

The default targets flatten what is there: the share of a source, language or topic is its token share to the power
``FLATTEN``. Any other targets may be given. A topic is any column; by default it is told by the text's content
(``sheafwork.llm.topics``).

Cells come to the driver only while they are at most ``CELLS``; beyond that, raking runs on the cells as a table, with
the same rounds and the same test of closeness, and the driver holds a number a value of each side (sources, languages,
topics), not a number a document. A value without a target has the target 0: its rows stay, with a
probability of 0.

Defined cases: null source, language or topic is a value of its own; null and empty texts have no tokens and the topic
``none``, their weight is their cell's; cells without tokens get weight 1; a null doc_id is drawn by its text; equal
rows share their draw; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sheafwork.llm.common import bounded_batches, durable, free_prefix, map_arrow
from sheafwork.llm.topics import features, with_topic, with_topic_of

FLATTEN, SHARE, ROUNDS, CLOSE = 0.7, 0.8, 200, 1e-9
CELLS, SEED = 100_000, 17
SIDES = ("source", "lang", "topic")


def tokens() -> Column:
    text = F.trim(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, r"\s+"))).cast("bigint")


_BLANK = bytes(32 if k in b" \t\n\x0b\f\r" else 120 for k in range(256))


def _token_counts(texts: list[bytes | None]) -> list[int]:
    """``tokens`` of UTF-8 texts."""
    marks = [t.strip(b" ").translate(_BLANK) if t else b"" for t in texts]
    return [m.count(b" x") + m.startswith(b"x") + m.startswith(b" ") + m.endswith(b" ") for m in marks]


def flattened(sums: dict, power: float) -> dict:
    """Target shares: each value's share to a power, scaled to 1."""
    raised = {k: float(v) ** power if v > 0 else 0.0 for k, v in sums.items()}
    total = sum(raised.values()) or 1.0
    return {k: v / total for k, v in raised.items()}


def rake(mass: np.ndarray, sides: list[np.ndarray], targets: list[np.ndarray], rounds: int | None = None, close: float = CLOSE) -> np.ndarray:
    """Weights of the cells. sides: each cell's value per side, as a number; targets: each value's share of all tokens."""
    weight, total = np.ones(len(mass)), mass.sum()
    for _ in range(ROUNDS if rounds is None else rounds):
        worst = 0.0
        for value, target in zip(sides, targets, strict=True):
            now = np.bincount(value, mass * weight, len(target))
            factor = np.where(now > 0, target * total / np.where(now > 0, now, 1), 1.0)
            worst = max(worst, np.abs(factor[now > 0] - 1).max(initial=0))
            weight *= factor[value]
        if worst < close:
            break
    return weight


def scale_for(mass: np.ndarray, weight: np.ndarray, wanted: float) -> float:
    """The c with sum(mass * min(1, c * weight)) = wanted, as far as that can be reached."""
    low, high = 0.0, 1.0
    while high < 1e12 and (mass * np.minimum(1, high * weight)).sum() < wanted - 1e-9:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if (mass * np.minimum(1, middle * weight)).sum() < wanted:
            low = middle
        else:
            high = middle
    return high


def _rake_table(cells: DataFrame, targets: list[dict], rounds: int, close: float = CLOSE) -> DataFrame:
    """``rake`` over more cells than the driver takes. A cell's weight is the product of its sides' factors: the driver
    has these, a number a value of one side, and every step sums the cells' tasks without moving cells."""
    spark = cells.sparkSession
    bounded_batches(spark)
    values = [[r[0] for r in cells.select(side).distinct().collect()] for side in SIDES]  # a row a value of one side
    for side, own in zip(SIDES, values, strict=True):
        numbered = spark.createDataFrame([(v, k) for k, v in enumerate(own)], f"v_{side} string, k_{side} int")
        cells = cells.join(numbered, F.col(side).eqNullSafe(F.col(f"v_{side}"))).drop(f"v_{side}")
    cells = durable(cells)
    total = cells.agg(F.sum("mass")).first()[0] or 0
    aims = [np.array([float(t.get(v, 0.0)) for v in own]) * total for t, own in zip(targets, values, strict=True)]
    factors = [np.ones(len(own)) for own in values]
    numbers = cells.select("mass", *[f"k_{side}" for side in SIDES])

    def weights(batch: pa.RecordBatch, at: int) -> np.ndarray:
        return np.prod([f[batch.column(at + k).to_numpy()] for k, f in enumerate(factors)], axis=0)

    def sums(side: int) -> np.ndarray:
        def run(batches):
            out = np.zeros(len(factors[side]))
            for batch in batches:
                out += np.bincount(batch.column(1 + side).to_numpy(), batch.column(0).to_numpy() * weights(batch, 1), len(out))
            has = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(out[has])], ["value", "part"])

        now = np.zeros(len(factors[side]))
        for value, part in numbers.mapInArrow(run, "value bigint, part double").groupBy("value").agg(F.sum("part")).collect():
            now[value] = part
        return now

    for _ in range(rounds):
        worst = 0.0
        for side, aim in enumerate(aims):
            now = sums(side)
            factor = np.where(now > 0, aim / np.where(now > 0, now, 1), 1.0)
            worst = max(worst, np.abs(factor[now > 0] - 1).max(initial=0))
            factors[side] = factors[side] * factor
        if worst < close:
            break

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(weights(batch, 4))], [*SIDES, "mass", "weight"])

    own = cells.select(*SIDES, F.col("mass").cast("bigint").alias("mass"), *[f"k_{side}" for side in SIDES])
    return durable(map_arrow(own, weigh, ", ".join(f"{side} string" for side in SIDES) + ", mass bigint, weight double"))


def _draw(seed: int) -> Column:
    text_key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text").cast("string")))
    return F.xxhash64(F.col("doc_id").cast("bigint"), text_key, F.lit(seed)) / float(1 << 64) + 0.5


def _read_once(docs: DataFrame, own: str, seed: int) -> DataFrame:
    """doc_id and what the mixing needs, topics by content: texts are read once, the rest is made of their features."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *[F.col(c).cast("string").alias(f"{own}{c}") for c in ("source", "lang")], _draw(seed).alias(f"{own}draw"))
    told = durable(features(rows, ["doc_id", f"{own}source", f"{own}lang", f"{own}draw"], ((f"{own}tokens", LongType(), _token_counts),)))
    return with_topic_of(told, f"{own}topic")


def _drawn(docs: DataFrame, own: str, topic_col: Column | None, seed: int) -> DataFrame:
    """The table with what the mixing needs, in columns that begin with ``own``."""
    base = docs.withColumn(f"{own}topic", topic_col.cast("string")) if topic_col is not None else with_topic(docs, f"{own}topic")
    base = base.withColumn(f"{own}tokens", tokens())
    return base.withColumn(f"{own}source", F.col("source").cast("string")).withColumn(f"{own}lang", F.col("lang").cast("string")).withColumn(f"{own}draw", _draw(seed))


def _weighted(drawn: DataFrame, own: str, cells: DataFrame, bounded: bool) -> DataFrame:
    cells = cells.toDF(*[f"{own}{c}" for c in cells.columns])
    same = [F.col(f"{own}{side}").eqNullSafe(F.col(f"{own}c_{side}")) for side in SIDES]
    return drawn.join(F.broadcast(cells) if bounded else cells, same[0] & same[1] & same[2])


def _narrow(drawn: DataFrame, own: str) -> DataFrame:
    return drawn.select(*[F.col(f"{own}{c}").alias(c) for c in (*SIDES, "tokens")])


def mix(docs: DataFrame, targets: dict[str, dict] | None = None, topic_col: Column | None = None, share: float = SHARE, flatten: float = FLATTEN, seed: int = SEED) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, draw, kept for every document.

    targets: {"source": {value: share}, "lang": ..., "topic": ...}; a side left out gets the default.
    """
    own = free_prefix(docs)
    narrow = docs.select("doc_id", "text", "source", "lang") if topic_col is None else docs
    drawn = durable((_drawn(narrow, own, topic_col, seed) if topic_col is not None else _read_once(narrow, own, seed)).select(F.col("doc_id").cast("bigint").alias("doc_id"), *[f"{own}{c}" for c in (*SIDES, "tokens", "draw")]))
    weighted = _weighted(drawn, own, *_weights(_narrow(drawn, own), targets, share, flatten))
    shown = [F.col(f"{own}{c}").alias(c) for c in (*SIDES, "tokens", "weight", "probability", "draw")]
    return weighted.select("doc_id", *shown, (F.col(f"{own}draw") < F.col(f"{own}probability")).alias("kept"))


def sampled(docs: DataFrame, targets: dict[str, dict] | None = None, topic_col: Column | None = None, share: float = SHARE, flatten: float = FLATTEN, seed: int = SEED) -> DataFrame:
    """The rows that the mixing keeps, all columns as they are. Only cells are counted first; texts aren't moved while cells are few."""
    own = free_prefix(docs)
    drawn = _drawn(docs, own, topic_col, seed)
    return _weighted(drawn, own, *_weights(_narrow(drawn, own), targets, share, flatten)).where(F.col(f"{own}draw") < F.col(f"{own}probability")).select(*docs.columns)


def _weights(narrow: DataFrame, targets: dict[str, dict] | None, share: float, flatten: float) -> tuple[DataFrame, bool]:
    """A row a cell (c_source, c_lang, c_topic, weight, probability), and whether its size is bounded by CELLS."""
    spark = narrow.sparkSession
    cells = durable(narrow.groupBy(*SIDES).agg(F.sum("tokens").alias("mass")))
    small = cells.count() <= CELLS

    def wanted(side: str) -> dict:
        if targets and side in targets:
            return targets[side]
        sums = {r[0]: r[1] for r in cells.groupBy(side).agg(F.sum("mass")).collect()}  # a row a value of one side
        return flattened(sums, flatten)

    aims = [wanted(side) for side in SIDES]
    fields = "c_source string, c_lang string, c_topic string, weight double, probability double"
    if small:
        rows = cells.collect()
        mass = np.array([r["mass"] for r in rows], dtype=np.float64)
        values = [{v: k for k, v in enumerate(dict.fromkeys(r[side] for r in rows))} for side in SIDES]
        weight = rake(mass, [np.array([v[r[side]] for r in rows], dtype=np.int64) for side, v in zip(SIDES, values, strict=True)], [np.array([aim.get(x, 0.0) for x in v]) for aim, v in zip(aims, values, strict=True)])
        chance = np.minimum(1.0, scale_for(mass, weight, share * mass.sum()) * weight)
        return spark.createDataFrame([(*(r[s] for s in SIDES), float(a), float(b)) for r, a, b in zip(rows, weight, chance, strict=True)], fields), True
    raked = _rake_table(cells, aims, ROUNDS)
    total, low, high = raked.agg(F.sum("mass")).first()[0] or 0, 1e-9, 1e12
    for _ in range(9):  # 60 scales a pass, evenly between the logarithms of the bounds
        tried = np.geomspace(low, high, 60).tolist()
        reached = raked.agg(*[F.sum(F.col("mass") * F.least(F.lit(1.0), F.col("weight") * c)) for c in tried]).first()
        first = next((k for k, x in enumerate(reached) if (x or 0) >= share * total), len(tried) - 1)
        low, high = tried[max(0, first - 1)], tried[first]
    return raked.select(*[F.col(s).alias(f"c_{s}") for s in SIDES], "weight", F.least(F.lit(1.0), F.col("weight") * high).alias("probability")), False
