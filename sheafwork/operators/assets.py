"""Assets: pairing of separate streams, routes, roles, validation, promotion and checks of artifact sets, sandboxes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from sheafwork.functions.pytext import ratio

WINDOW, MARGIN = 900.0, 0.04
#: Audios of a duration bucket that a chunk holds, and videos that it is given at least; larger buckets are cut into chunks that all meet.
AUDIOS, VIDEOS = 200_000, 5_000
#: Likenesses of names that a task remembers; beyond that, it starts afresh.
REMEMBERED = 500_000
#: Audios of a video's own name, before and after it in time, that give the first bound of its scores.
NEAR = 16


def name_key(name: Column) -> Column:
    """A file name without extension, copy number and anything but word characters."""
    stem = F.regexp_replace(F.regexp_replace(F.lower(name), r"\.[^.]*$", ""), r"[_\-\s]+\d+$", "")
    return F.regexp_replace(stem, r"(?U)[^\w]+", "")


def _rounded(x: np.ndarray) -> np.ndarray:
    """Five places, half up by the shortest decimal form, as Spark rounds."""
    scaled = x * 1e5
    out = np.floor(scaled + 0.5) / 1e5
    for k in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6):
        out[k] = float(Decimal(repr(float(x[k]))).quantize(Decimal("0.00001"), ROUND_HALF_UP))
    return out


class Audios:
    """Audios of one chunk, sorted by modified time, searched for the best two of every video of a block."""

    def __init__(self, ids: pa.Array, several: np.ndarray, duration: np.ndarray, modified: np.ndarray, names: list[str], likeness: Callable[[str, str], float], known: dict, window: float):
        order = np.argsort(modified, kind="stable")
        self.place, self.several, self.duration, self.modified = order, several[order], duration[order], modified[order]
        self.ids, self.likeness, self.known, self.window = ids, likeness, known, window
        self.rank = np.empty(len(order), dtype=np.int64)  # the order of ids
        self.rank[pc.sort_indices(ids.take(pa.array(order))).to_numpy()] = np.arange(len(order))
        number = {name: k for k, name in enumerate(dict.fromkeys(names))}
        self.names, self.name, self.number = list(number), np.array([number[names[k]] for k in order], dtype=np.int64), number
        self.alike = np.argsort(self.name, kind="stable")  # by name, then by modified time
        self.first = np.searchsorted(self.name[self.alike], np.arange(len(number) + 1))
        self.shortest, self.longest = duration.min(), duration.max()

    def of_same_name(self, duration: np.ndarray, modified: np.ndarray, name: list[str]) -> np.ndarray:
        """A score with names that two pairs of each video are sure to reach: the second best of the audios of its own name that are nearest in time."""
        out = np.full(len(name), -np.inf)
        spread = np.arange(-NEAR, NEAR)
        groups: dict[str, list[int]] = {}
        for k, x in enumerate(name):
            if x in self.number:
                groups.setdefault(x, []).append(k)
        for x, rows in groups.items():
            own = self.alike[self.first[self.number[x]] : self.first[self.number[x] + 1]]
            at = np.searchsorted(self.modified[own], modified[rows])[:, None] + spread
            there = (at >= 0) & (at < len(own))
            found = own[np.clip(at, 0, len(own) - 1)]
            base = self._base(duration[rows], modified[rows], self.duration[found], self.modified[found])
            base[~there] = -np.inf
            second = np.partition(base, -2, axis=1)[:, -2]
            several = np.where(self.several[found], base, -np.inf).max(axis=1)
            key = x, x
            if key not in self.known:
                self.known[key] = self.likeness(x, x)
            out[rows] = np.maximum(second, several) + 0.15 * self.known[key]
        return out

    def _base(self, duration: np.ndarray, modified: np.ndarray, of: np.ndarray, when: np.ndarray) -> np.ndarray:
        tolerance = np.maximum(1.0, duration * 0.002)[:, None]
        delta = np.abs(duration[:, None] - of)
        with np.errstate(invalid="ignore"):
            late = np.abs(modified[:, None] - when)
        base = 0.50 * (1 - delta / tolerance) + 0.35 * np.fmax(0.0, 1 - late / self.window)
        base[delta > tolerance] = -np.inf
        return base

    def base(self, low: int, high: int, duration: np.ndarray, modified: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores without names of a video a row and an audio a column, minus infinity beyond the tolerance; and a score that two pairs of each video are sure to reach, as a likeness is 0 at least."""
        base = self._base(duration, modified, self.duration[None, low:high], self.modified[None, low:high])
        least = np.partition(base, -2, axis=1)[:, -2] if high - low > 1 else np.full(len(base), -np.inf)
        if (several := self.several[low:high]).any():
            least = np.maximum(least, base[:, several].max(axis=1))
        return base, least

    def likenesses(self, names: list[str], own: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The likeness of each pair of a video's name, numbered ``own``, and an audio; each pair of names is compared once."""
        pairs, inverse = np.unique(own * len(self.names) + self.name[at], return_inverse=True)
        out = np.empty(len(pairs))
        for k, (one, other) in enumerate(zip((pairs // len(self.names)).tolist(), (pairs % len(self.names)).tolist(), strict=True)):
            key = names[one], self.names[other]
            if (found := self.known.get(key)) is None:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                found = self.known[key] = self.likeness(*key)
            out[k] = found
        return out[inverse]

    def best(self, duration: np.ndarray, modified: np.ndarray, name: list[str], bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Videos with a pair, the best audio's place, its score and the second best score, NaN if there is none. Videos sorted by modified time. bound: what two pairs of each video reach elsewhere; pairs below may be left out."""
        n, cells, start, found = len(self.modified), 1 << 19, 0, []
        number = {x: k for k, x in enumerate(dict.fromkeys(name))}
        names, code = list(number), np.array([number[x] for x in name], dtype=np.int64)
        sure = np.maximum(self.of_same_name(duration, modified, name), bound)
        # By duration alone, no audio of the chunk reaches more than this.
        most = 0.50 * (1 - np.maximum(0.0, np.maximum(self.shortest - duration, duration - self.longest)) / np.maximum(1.0, duration * 0.002))
        while start < len(duration):
            end = min(len(duration), start + 128)
            first, last = modified[start], modified[end - 1]
            low, high = max(0, int(np.searchsorted(self.modified, first)) - 32), min(n, int(np.searchsorted(self.modified, last, "right")) + 32)
            end = min(end, start + max(1, cells // max(1, high - low)))
            least = np.maximum(self.base(low, high, duration[start:end], modified[start:end])[1], sure[start:end])
            # What lies further off in time than ``reach`` can't come up to that: a likeness is 1 at most.
            reach = (self.window * (1 - (least - 0.15 - 2e-5 - most[start:end]) / 0.35)).max()
            low, high = 0, n
            if reach < self.window and np.isfinite(modified[start:end]).all():
                low, high = (int(np.searchsorted(self.modified, modified[start] - reach)), int(np.searchsorted(self.modified, modified[end - 1] + reach, "right"))) if reach > -1e-6 * self.window else (0, 0)
            end = min(end, start + max(1, cells // max(1, high - low)))
            found += [] if low >= high else self._of_block(low, high, start, duration[start:end], modified[start:end], names, code[start:end], sure[start:end])
            start = end
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))

    def _of_block(self, low: int, high: int, start: int, duration: np.ndarray, modified: np.ndarray, names: list[str], code: np.ndarray, sure: np.ndarray) -> list[tuple]:
        base, least = self.base(low, high, duration, modified)
        row, at = np.nonzero(base >= np.maximum(np.maximum(least, sure) - 0.15 - 2e-5, -1.0)[:, None])  # scores are rounded to five places
        if not len(row):
            return []
        base, at = base[row, at], at + low
        # The pairs ahead without names are compared first, the others only where they still can come second.
        order = np.lexsort((-base, row))
        row, at, base = row[order], at[order], base[order]
        ahead = np.arange(len(row)) - np.searchsorted(row, row) < 8
        score = np.full(len(row), -np.inf)
        for phase in range(2):
            now = ahead if phase == 0 else ~ahead
            score[now] = _rounded(base[now] + 0.15 * self.likenesses(names, code[row[now]], at[now]))
            order = np.lexsort((self.rank[at], -score, row))
            row, at, base, score, ahead = row[order], at[order], base[order], score[order], ahead[order]
            head = np.flatnonzero(np.diff(row, prepend=-1))
            after = np.append(score[1:], np.nan)[head]
            after[np.append(row[1:], -1)[head] != row[head]] = np.nan
            second = np.where(self.several[at[head]], score[head], after)
            if ahead.all():
                break
            kept = ahead | (base + 0.15 >= np.nan_to_num(second, nan=-np.inf)[np.searchsorted(row[head], row)] - 2e-5)
            if phase == 0:
                row, at, base, score, ahead = row[kept], at[kept], base[kept], score[kept], ahead[kept]
        return [(row[head] + start, self.place[at[head]], score[head], np.where(np.isfinite(second), second, np.nan))]


def _search(likeness: Callable[[str, str], float], window: float):
    """Batches sorted by chunk, in it audios (side 0), videos (1) and videos' pairs found before (2). Every video comes back with the
    best audio of its chunk, the score and the second best score, null where there is none; pairs found before come back as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        chunk, parts, audios = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(5)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in pairwise(cuts):
                if start == end:
                    continue
                own, part = tuple(keys[:4, start].tolist()), batch.slice(start, end - start)
                if own != chunk:
                    chunk, parts, audios = own, [], None
                side = keys[4, start]
                if side == 0:
                    parts.append(part)
                    continue
                if side == 1 and parts and audios is None:
                    table = pa.Table.from_batches(parts).combine_chunks()
                    numbers = [table.column(name).to_numpy() for name in ("several", "duration", "modified")]
                    audios = Audios(table.column("audio_id").combine_chunks(), *numbers, table.column("name").to_pylist(), likeness, known, window)
                columns = {name: part.column(name) for name in ("a_chunk", "video_id", "audio_id", "score", "second", "duration", "modified", "name")}
                if side == 1:
                    columns |= dict(zip(("audio_id", "score", "second"), _found(part, audios), strict=True))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _found(part: pa.RecordBatch, audios: Audios | None) -> tuple[pa.Array, pa.Array, pa.Array]:
    kind = part.schema.field("audio_id").type
    if audios is None:
        return pa.nulls(len(part), kind), pa.nulls(len(part), pa.float64()), pa.nulls(len(part), pa.float64())
    duration, modified, name = part.column("duration").to_numpy(), part.column("modified").to_numpy(), part.column("name").to_pylist()
    bound = part.column("second").fill_null(-np.inf).to_numpy()
    fresh = np.ones(len(name), bool)  # equal videos follow each other
    fresh[1:] = (np.diff(duration) != 0) | (modified[1:] != modified[:-1]) | (bound[1:] != bound[:-1]) | np.array([x != y for x, y in pairwise(name)], dtype=bool)
    firsts, of = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    row, place, score, second = audios.best(duration[firsts], modified[firsts], [name[k] for k in firsts.tolist()], bound[firsts])
    spot = np.full(len(firsts), -1)
    spot[row] = np.arange(len(row))
    spot = spot[of]
    at = pa.array(spot, mask=spot < 0)
    return audios.ids.take(pa.array(place)).take(at), pa.array(score).take(at), pa.array(second, from_pandas=True).take(at)


def pair_streams(videos: DataFrame, audios: DataFrame, likeness: Callable[[str, str], float] | None = None, window: float = WINDOW, margin: float = MARGIN) -> DataFrame:
    """Both sides id, name, duration, modified. A band join on the duration, made an equality by buckets, then the best two.

    A score is 0.5 by duration, 0.35 by modified time, which counts only within ``window`` seconds, and 0.15 by the names'
    likeness, from 0 to 1. Pairs never become rows: a task holds the audios of a bucket, sorted by time, and keeps two
    scores of a video. Scores of audios near in time bound how far off in time an audio may lie, and scores without
    names, and those of audios of a video's own name, bound which pairs have their names compared. Audios that agree in
    all but the id are one, by their least id. A bucket's videos are cut into chunks of as many rows as it has audios, so
    that audios sent to every chunk are no more rows than the two sides together; only beyond ``AUDIOS`` in one bucket is a
    video sent to more than one chunk of these.

    Durations of like magnitude share a class of powers of two, whose bucket is as wide as that class's largest tolerance
    (1 second, or 0.002 of the duration). Durations that are null or not finite pair with nothing, modified times that are
    null or NaN lie outside of the window.
    """
    finite = F.abs(F.col("duration")) < float("inf")
    octave = lambda d: F.greatest(F.lit(0), F.floor(F.log2(F.greatest(d, F.lit(1.0))))).cast("int")
    width = lambda o: F.greatest(F.lit(1.0), F.pow(F.lit(2.0), o + 1) * 0.002)
    own = [F.col("duration").cast("double").alias("duration"), F.nanvl(F.coalesce(F.col("modified").cast("double"), F.lit(float("inf"))), F.lit(float("inf"))).alias("modified"), F.coalesce(name_key(F.col("name")), F.lit("")).alias("name")]
    a = audios.select(F.col("id").alias("audio_id"), *own).where(finite).groupBy("duration", "modified", "name").agg(F.min("audio_id").alias("audio_id"), (F.count(F.lit(1)) > 1).alias("several"))
    bucket = lambda d, o: F.floor(d / width(o))
    a = a.withColumn("octave", octave(F.col("duration"))).withColumn("bucket", bucket(F.col("duration"), F.col("octave")))
    v = videos.select(F.col("id").alias("video_id"), *own).where(finite)
    home = v.withColumn("octave", octave(F.col("duration"))).withColumn("bucket", bucket(F.col("duration"), F.col("octave")))
    tolerance = F.greatest(F.lit(1.0), F.col("duration") * 0.002)
    reach = tolerance + F.abs(F.col("duration")) * 1e-12  # what rounding may add
    octaves = F.array_distinct(F.array(octave(F.col("duration") - reach), octave(F.col("duration")), octave(F.col("duration") + reach)))
    inside = lambda o: F.transform(F.sequence(bucket(F.col("duration") - reach, o), bucket(F.col("duration") + reach, o)), lambda b: F.struct(o.alias("octave"), b.alias("bucket")))
    here = lambda x: (x["octave"] == octave(F.col("duration"))) & (x["bucket"] == bucket(F.col("duration"), octave(F.col("duration"))))
    near = F.filter(F.flatten(F.transform(octaves, inside)), lambda x: ~here(x))
    visits = v.select(F.explode(near).alias("x")).select("x.*")
    chunk = F.pmod(F.xxhash64("duration", "modified", "name"), F.lit(1 << 31))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["octave", "bucket", "a_chunk", "v_chunk"]
    video_id, audio_id = videos.schema["id"].dataType, audios.schema["id"].dataType
    spread = int(videos.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work is by pairs, not by the bytes by which tasks would be merged
    fields = [StructField("a_chunk", IntegerType()), StructField("video_id", video_id), StructField("audio_id", audio_id), StructField("score", DoubleType()), StructField("second", DoubleType()), StructField("duration", DoubleType()), StructField("modified", DoubleType()), StructField("name", StringType())]

    def met(rows: DataFrame, visitors: DataFrame) -> DataFrame:
        """The search of rows, of side 1 or 2, among the audios of their buckets; visitors: at least those of side 1."""
        both = a.select("octave", "bucket", F.lit(1).alias("a"), F.lit(0).alias("v")).unionByName(visitors.select("octave", "bucket", F.lit(0).alias("a"), F.lit(1).alias("v")))
        videos_each = F.greatest(F.lit(VIDEOS), F.least(F.lit(AUDIOS), F.sum("a")))
        sizes = both.groupBy("octave", "bucket").agg(F.ceil(F.sum("a") / AUDIOS).cast("int").alias("a_chunks"), F.ceil(F.sum("v") / videos_each).cast("int").alias("v_chunks")).where("a_chunks > 0 and v_chunks > 0")
        left = a.join(sizes, ["octave", "bucket"]).withColumn("a_chunk", (chunk % F.col("a_chunks")).cast("int")).withColumn("v_chunk", every("v_chunks"))
        left = left.select(*keys, F.lit(0).alias("side"), F.lit(None).cast(video_id).alias("video_id"), "audio_id", "several", "duration", "modified", "name", F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("second"))
        right = rows.join(sizes, ["octave", "bucket"], "left").withColumn("v_chunk", F.coalesce((chunk % F.col("v_chunks")).cast("int"), F.lit(0)))
        right = right.withColumn("a_chunk", F.explode(F.when(F.col("side") == 1, F.sequence(F.lit(0), F.coalesce("a_chunks", F.lit(1)) - 1)).otherwise(F.array(F.lit(0)))))
        right = right.select(*keys, "side", "video_id", "audio_id", F.lit(False).alias("several"), "duration", "modified", "name", "score", "second")
        dealt = left.unionByName(right).repartition(spread, *keys).sortWithinPartitions(*keys, "side", "modified", "duration", "name")
        return dealt.mapInArrow(_search(likeness or ratio, window), StructType(fields))

    first = met(home.withColumns({"side": F.lit(1), "audio_id": F.lit(None).cast(audio_id), "score": F.lit(None).cast("double"), "second": F.lit(None).cast("double")}), home)
    off = lambda x: F.greatest(F.lit(0.0), x["bucket"] * width(x["octave"]) - F.col("duration"), F.col("duration") - (x["bucket"] + 1) * width(x["octave"]))
    open_ = F.filter(near, lambda x: F.col("second").isNull() | (1 - 0.50 * off(x) / tolerance >= F.col("second") - 2e-5))
    found_before = F.struct(octave(F.col("duration")).alias("octave"), bucket(F.col("duration"), octave(F.col("duration"))).alias("bucket"), F.lit(2).alias("side"))
    to = F.concat(F.when(F.col("score").isNotNull(), F.array(found_before)).otherwise(F.array().cast("array<struct<octave:int,bucket:bigint,side:int>>")), F.when(F.col("a_chunk") == 0, F.transform(open_, lambda x: F.struct(x["octave"], x["bucket"], F.lit(1).alias("side")))).otherwise(F.array().cast("array<struct<octave:int,bucket:bigint,side:int>>")))
    onward = first.withColumn("to", F.explode(to)).select("*", "to.*").withColumns({"name": F.when(F.col("side") == 1, F.col("name")), "audio_id": F.when(F.col("side") == 2, F.col("audio_id")), "score": F.when(F.col("side") == 2, F.col("score"))}).drop("a_chunk", "to")
    found = met(onward, visits).where("score is not null")
    scores = F.sort_array(F.flatten(F.collect_list(F.array("score", "second"))), asc=False)  # two a chunk that the video meets
    best = found.groupBy("video_id").agg(F.min(F.struct((-F.col("score")).alias("minus"), "audio_id")).alias("first"), F.get(scores, F.lit(1)).alias("second"))
    best = best.select("video_id", "first.audio_id", (-F.col("first.minus")).alias("score"), "second")
    decision = F.when(F.col("score").isNull(), "missing_audio").when(F.col("score") - F.col("second") <= margin, "pair_ambiguous").otherwise("pair_found")
    joined = videos.select(F.col("id").alias("video_id")).join(best, "video_id", "left").withColumn("decision", decision)
    return joined.select("video_id", "decision", F.when(F.col("decision") == "pair_found", F.col("audio_id")).alias("audio_id"), F.when(F.col("decision") == "pair_found", F.col("score")).alias("score"))


def conformity(artifacts: DataFrame) -> DataFrame:
    """task_id, mode ('video' or 'album'), role, sequence -> counts and the first fault of each task's artifact set."""
    role = F.col("role")
    facts = artifacts.groupBy("task_id", "mode").agg(
        F.count_if(role == "primary_video").alias("videos"), F.count_if(role == "album_image").alias("images"), F.count_if(role == "bgm_audio").alias("audios"),
        F.count_if((role == "album_image") & (F.coalesce("sequence", F.lit(0)) <= 0)).alias("unnumbered"), F.countDistinct(F.when(role == "album_image", F.col("sequence"))).alias("numbers"), F.max(F.when(role == "album_image", F.col("sequence"))).alias("highest"),
    )
    v, i = F.col("videos"), F.col("images")
    fault = (
        F.when((v > 0) & (i > 0), "mixed_primaries")
        .when((F.col("mode") == "video") & (i > 0), "route_mismatch")
        .when((F.col("mode") == "video") & (v == 0), "missing_video")
        .when((F.col("mode") == "video") & (v > 1), "multiple_videos")
        .when((F.col("mode") == "album") & (v > 0), "route_mismatch")
        .when((F.col("mode") == "album") & (i == 0), "missing_images")
        .when((F.col("mode") == "album") & (F.col("unnumbered") > 0), "invalid_sequence")
        .when((F.col("mode") == "album") & (F.col("numbers") < i), "duplicate_sequence")
        .when((F.col("mode") == "album") & (F.col("highest") != i), "sequence_gap")
    )
    return facts.select("task_id", "mode", "videos", "images", "audios", fault.alias("fault"))


# Extensions by what a file holds, and those of files beside the media.
VIDEO = (".mp4", ".mov", ".mkv", ".flv", ".webm", ".avi", ".ts")
IMAGE = (".webp", ".jpg", ".jpeg", ".png", ".bmp", ".heic")
AUDIO = (".mp3", ".m4a", ".aac", ".wav", ".flac", ".ogg")
BESIDE = (".txt", ".json", ".log", ".desc")


def extension_of(name: Column) -> Column:
    """The last extension with its dot, lower case; empty where there is none."""
    return F.regexp_extract(F.lower(name), r"[^/\\.]+(\.[^./\\]+)$", 1)


def role_of(name: Column) -> Column:
    """What a file is by its name: marks first, then its extension."""
    lower, ext = F.lower(name), extension_of(name)
    return (
        F.when(lower.rlike(r"_img_\d+"), "album_image")
        .when(lower.contains("_bgm"), "bgm_audio")
        .when(lower.contains("_cover"), "cover_image")
        .when(ext.isin(list(VIDEO)), "primary_video")
        .when(ext.isin(list(IMAGE)), "album_image")
        .when(ext.isin(list(AUDIO)), "bgm_audio")
        .otherwise("other_diagnostic")
    )


def sequence_of(name: Column, given: Column) -> Column:
    """An album image's number: the given one, or the one in its name; null for all other files."""
    told = F.regexp_extract(F.lower(name), r"_img_(\d+)", 1).try_cast("int")
    return F.when(role_of(name) == "album_image", F.coalesce(given, told))


def media_files(files: DataFrame) -> DataFrame:
    """Files (file_name, role) without diagnostics and what lies beside the media; unfinished ones get a fault."""
    from sheafwork.functions.scalars import UNFINISHED

    ext = extension_of(F.col("file_name"))
    kept = files.where((F.col("role") != "other_diagnostic") & ~ext.isin(list(BESIDE)))
    return kept.withColumn("fault", F.when(ext.isin(list(UNFINISHED)), "unfinished"))


def routes(tasks: DataFrame) -> DataFrame:
    """How a task (content_type, has_audio, image_count) is run and what it must yield; by its content type alone.

    Anything but video and image_album is unsupported: its route is null and its fault says so.
    """
    kind = F.lower(F.trim(F.coalesce("content_type", F.lit(""))))
    video, album = kind == "video", kind == "image_album"
    audio = F.coalesce("has_audio", F.lit(False))
    images = F.when(F.coalesce(F.col("image_count") > 0, F.lit(False)), F.col("image_count")).otherwise(1)
    return tasks.withColumns({
        "mode": F.when(video, "video").when(album, "image_album"), "profile": F.when(video, "VIDEO").when(album, "IMAGE_SET"), "primary_role": F.when(video, "primary_video").when(album, "album_image"),
        "min_primary": F.when(video, 1).when(album, images), "max_primary": F.when(video, 1), "require_audio": F.when(video, audio).when(album, False), "strict_sequence": F.when(video, False).when(album, True),
        "fault": F.when(~(video | album), "unsupported_content_type"),
    })


def media_verdicts(probes: DataFrame) -> DataFrame:
    """First failed check of each probed file, its error code, and whether its length is odd.

    probes: profile (VIDEO, AUDIO), has_video, has_audio, expect_audio, width, height, duration, expected_ms, decodes (null
    where not tried). A length is odd if it is off by more than 3 seconds and a fifth of what was expected.
    """
    c, no = F.col, F.lit(False)
    video, seconds = c("profile") == "VIDEO", F.coalesce("duration", F.lit(0.0))
    check = (
        F.when(video & ~F.coalesce("has_video", no), "MISSING_VIDEO_STREAM")
        .when((c("profile") == "AUDIO") & ~F.coalesce("has_audio", no), "MISSING_AUDIO_STREAM")
        .when(video & F.coalesce("expect_audio", no) & ~F.coalesce("has_audio", no), "MISSING_AUDIO_STREAM")
        .when(video & (F.coalesce(c("width") <= 0, no) | F.coalesce(c("height") <= 0, no)), "INVALID_DIMENSIONS")
        .when(video & (seconds <= 0), "INVALID_DURATION")
        .when(~F.coalesce("decodes", F.lit(True)), "DECODE_SMOKE_FAILURE")
    )
    wanted = c("expected_ms") / 1000
    odd = video & (wanted > 0) & (F.abs(seconds - wanted) > F.greatest(F.lit(3.0), wanted * 0.2))
    code = F.when(F.col("failed_check").startswith("MISSING"), "MEDIA_INCOMPLETE").when(F.col("failed_check").isNotNull(), "VALIDATION_FAILED")
    return probes.withColumn("failed_check", check).withColumns({"code": code, "passed": F.col("failed_check").isNull(), "odd_length": F.coalesce(odd, no) & F.col("failed_check").isNull()})


def image_set_verdicts(files: DataFrame, expected: DataFrame) -> DataFrame:
    """First failed check of each album. files: task_id, file_name, passed; expected: task_id, least, exactly (or null)."""
    audio = extension_of(F.col("file_name")).isin(list(AUDIO))
    counts = files.groupBy("task_id").agg(F.count_if(~audio).alias("images"), F.count_if(~audio & ~F.col("passed")).alias("bad_images"), F.count_if(audio & ~F.col("passed")).alias("bad_audios"))
    row = expected.join(counts, "task_id", "left").na.fill(0, ["images", "bad_images", "bad_audios"])
    check = (
        F.when(F.col("images") < F.coalesce("least", F.lit(1)), "IMAGE_COUNT_BELOW_MINIMUM")
        .when(F.col("images") != F.col("exactly"), "IMAGE_COUNT_MISMATCH")
        .when(F.col("bad_images") > 0, "IMAGE_SET_CORRUPT_MEMBER")
        .when(F.col("bad_audios") > 0, "IMAGE_SET_CORRUPT_AUDIO")
    )
    return row.select("task_id", "images", check.alias("failed_check"))


def promotions(candidates: DataFrame, archived: DataFrame) -> DataFrame:
    """Whether validated files may become an asset of the archive.

    candidates: content_id, file_name, sha256, byte_size, validated_sha256, validated; archived: content_id, file_name, sha256.
    Outcomes: rejected (reason: not_validated, unfinished, zero_bytes, changed_since), idempotent if the archive has the same
    files with the same digests, conflict if it has others, promoted otherwise. Sets of files are compared by their sums
    of digests of (name, digest) and their counts, so no set is gathered.
    """
    from sheafwork.functions.scalars import UNFINISHED

    reason = (
        F.when(~F.coalesce("validated", F.lit(False)), "not_validated")
        .when(extension_of(F.col("file_name")).isin(list(UNFINISHED)), "unfinished")
        .when(F.coalesce("byte_size", F.lit(0)) == 0, "zero_bytes")
        .when(~F.col("sha256").eqNullSafe(F.col("validated_sha256")), "changed_since")
    )
    mark = F.sum(F.xxhash64("file_name", "sha256").cast("decimal(38,0)"))
    new = candidates.withColumn("reason", reason).groupBy("content_id").agg(mark.alias("n_mark"), F.count(F.lit(1)).alias("n_files"), F.min("reason").alias("reason"))
    old = archived.groupBy("content_id").agg(mark.alias("o_mark"), F.count(F.lit(1)).alias("o_files"))
    same = (F.col("n_mark") == F.col("o_mark")) & (F.col("n_files") == F.col("o_files"))
    outcome = F.when(F.col("reason").isNotNull(), "rejected").when(F.col("o_files").isNull(), "promoted").when(same, "idempotent").otherwise("conflict")
    return new.join(old, "content_id", "left").select("content_id", outcome.alias("outcome"), "reason", F.col("n_files").alias("files"))


def archive_faults(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """First fault of each archived asset: no_assets, no_file_name, missing_file, other_digest.

    manifests: content_id, assets (array of struct(file_name, sha256)); files: content_id, file_name, sha256 as they are.
    """
    empty = manifests.where(F.coalesce(F.size("assets"), F.lit(0)) < 1).select("content_id", F.lit("no_assets").alias("fault"), F.lit(0).alias("at"))
    told = manifests.select("content_id", F.posexplode("assets").alias("at", "a")).select("content_id", "at", F.col("a.file_name").alias("file_name"), F.col("a.sha256").alias("want"))
    met = told.join(files.withColumnRenamed("sha256", "has"), ["content_id", "file_name"], "left")
    fault = F.when(F.coalesce("file_name", F.lit("")) == "", "no_file_name").when(F.col("has").isNull(), "missing_file").when((F.coalesce("want", F.lit("")) != "") & (F.col("want") != F.col("has")), "other_digest")
    bad = met.withColumn("fault", fault).where("fault is not null").select("content_id", "fault", "at")
    return empty.unionByName(bad).groupBy("content_id").agg(F.min_by("fault", "at").alias("fault"))


#: Seconds after which a sandbox whose owner is dead may go: a crashed one, a successful one, a failed one.
GRACE, KEPT, KEPT_FAILED = 600.0, 300.0, 86400.0


def sandboxes(boxes: DataFrame) -> DataFrame:
    """Class of each working folder and whether it may be deleted. boxes: metadata ('good', 'missing', 'corrupt'), state, alive, age.

    A living owner protects its folder whatever its age; folders without readable metadata are set aside, never deleted.
    """
    state, age = F.col("state"), F.greatest(F.lit(0.0), F.col("age"))
    kind = (
        F.when(F.col("metadata") != "good", "quarantine")
        .when(F.col("alive"), "active")
        .when(state.isin("ACTIVE", "INITIALIZING"), "orphaned")
        .when(state == "SUCCESS", "success")
        .when(state == "FAILED", "failed")
        .otherwise("unknown_state")
    )
    least = F.create_map(*[F.lit(x) for pair in (("orphaned", GRACE), ("success", KEPT), ("failed", KEPT_FAILED)) for x in pair])[F.col("kind")]
    return boxes.withColumn("kind", kind).withColumn("may_go", F.coalesce(age >= least, F.lit(False)))


def sandbox_summary(classified: DataFrame) -> DataFrame:
    """One row: scanned, living, set aside, kept failures, orphans, and folders to delete."""
    kind, go = F.col("kind"), F.col("may_go")
    return classified.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(kind == "active").alias("active"), F.count_if(kind == "quarantine").alias("quarantined"), F.count_if((kind == "failed") & ~go).alias("kept_failures"),
        F.count_if(kind == "orphaned").alias("orphaned"), F.count_if(go).alias("deletable"),
    )
