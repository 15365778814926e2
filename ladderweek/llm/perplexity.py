"""Quality rules: layout rules, then perplexity bands of a Kneser-Ney n-gram model per language.

The model's tokens are characters, each for itself (those beyond the 65,536 of the basic plane in 6,400 classes). Spark counts
the 4-grams of all documents that pass the layout rules, for each language; a gram is its four symbols side by side in a
64-bit number, so nothing is merged and the model grows with what is written in the corpus. Modified Kneser-Ney smoothing
(three discounts per order from the counts of counts, lower orders by the number of different left neighbours, interpolated down to even
chances) is done by Spark as well, in groups of one context, which has 65,536 followers at most. The log probabilities are
stored as shards by hash of the gram, each a sorted array of grams with its probabilities beside it. Shards of up
to ``broadcast_bytes`` together are sent to the workers at a time, which look grams up by binary search; a larger model
takes several passes over the documents, whose sums are added up.

A text's score is its negative log probability per word, the logarithm of its perplexity. Per language, the middle and the spread around it
come from exact counts of rounded scores, for texts of similar length (by powers of two), because short texts scatter more.
Both are taken where the scores lie closest, from different texts, so that a third of bad texts does not widen the band.
A text outside ``below`` and ``above`` spreads of its band is rejected.

Defined results: a NULL or blank text has no word; a text that fails the layout rules is not asked for its score, which is
NULL; NULL is a language of its own; a band of fewer than ``band_rows`` texts uses that of all lengths of its language;
repeated rows are judged alike; an empty table gives an empty one. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import release, stored

ORDER, BITS = 4, 16
#: Symbols beyond the basic plane share the codes of its private-use area.
PRIVATE, PRIVATE_CODES = 0xE000, 6400
#: Grams that a worker holds before it counts them, and that one shard of a model holds on average.
WAITING, SHARD_GRAMS = 2_000_000, 4_000_000
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
#: Multipliers of the eight words of a window, drawn once from a fixed seed.
MIX = np.random.default_rng(8).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
#: Below so many texts a band is as wide as the 10th and 90th percentile at least.
FEW = 20


def symbols_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 1 << BITS, codes, PRIVATE + codes % PRIVATE_CODES).astype(np.uint64)


def ngrams(symbols: np.ndarray) -> np.ndarray:
    """The 64-bit n-gram that ends at each symbol, as a signed number; symbol 0 stands before the text."""
    padded = np.concatenate((np.zeros(ORDER - 1, np.uint64), symbols))
    out = np.zeros(len(symbols), np.uint64)
    for k in range(ORDER):
        out = (out << np.uint64(BITS)) | padded[k : k + len(symbols)]
    return out.view(np.int64)


def repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text, the words that lie in a window of eight words found twice or more in it."""
    counts = np.array([len(w) for w in words], np.int64)
    total = int(counts.sum())
    if total < WINDOW:
        return np.zeros(len(words), np.int64)
    flat = np.fromiter((hash(w) for text in words for w in text), np.int64, total).view(np.uint64)
    owner = np.repeat(np.arange(len(words)), counts)
    n = total - WINDOW + 1
    rolled = owner[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(WINDOW):
        rolled = rolled + flat[k : k + n] * MIX[k]
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    _, which, times = np.unique(rolled[inside], return_inverse=True, return_counts=True)
    starts = inside[times[which] > 1]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(words))


def layout(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The base columns of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    words = [r.split() for r in raw]
    n_words = np.array([len(w) for w in words], np.int64)
    chars = np.array([len(t or "") for t in texts], np.int64)
    blanks = np.array([len(r) - len(r.translate(None, BLANK)) for r in raw], np.int64)
    signs = np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], np.int64)
    dup = []
    for r in raw:
        lines = [x for x in r.split(b"\n") if x.strip(BLANK)]
        dup.append(len(lines) - len(set(lines)))
    repeats = repeat_words(words)
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    return {
        "n_words": n_words,
        "word_chars": chars - blanks,
        "n_symbols": signs,
        "n_dup_lines": np.array(dup, np.int64),
        "n_repeat_words": repeats,
        "base_failed": failed,
    }


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all documents that pass the layout rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        waiting: dict[str | None, list[np.ndarray]] = {}
        sizes: dict[str | None, int] = {}

        def merged(lang) -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            sizes.pop(lang)
            langs = pa.array([lang] * len(grams), pa.string())
            return pa.RecordBatch.from_arrays([langs, pa.array(grams), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                langs, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
                failed = layout(texts)["base_failed"]
                for lang, text, bad in zip(langs, texts, failed.tolist(), strict=True):
                    if not bad:
                        grams = ngrams(symbols_of(text))
                        waiting.setdefault(lang, []).append(grams)
                        sizes[lang] = sizes.get(lang, 0) + len(grams)
                        if sum(sizes.values()) > WAITING:
                            yield merged(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield merged(lang)

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def suffix(symbols: int) -> Column:
    """The last symbols of a gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << BITS * symbols) - 1))


def discounts(counts: DataFrame) -> DataFrame:
    """(key, d1, d2, d3): the discounts of counts 1, 2 and 3 or more, from how many n-grams have count 1 to 4."""
    seen = [F.greatest(F.lit(1.0), F.count_if(F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    n = [F.col(f"n{k}") for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    cuts = [
        F.greatest(F.lit(0.05), F.least(F.lit(0.95 * k), k - (k + 1) * y * n[k] / n[k - 1])).alias(f"d{k}") for k in (1, 2, 3)
    ]
    return counts.groupBy("key").agg(*seen).select("key", *cuts)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp) of every counted gram.

    Each order takes one window over the followers of a context and one join with the order below by the gram's last symbols.
    """
    named = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang")))  # a key without NULL
    levels = [counts.select(named.alias("key"), "gram", "n")]
    for order in range(ORDER - 1, 0, -1):  # lower orders count different left neighbours
        levels.append(levels[-1].groupBy("key", suffix(order).alias("gram")).agg(F.count("*").alias("n")))
    lower = None
    for order, level in enumerate(reversed(levels), 1):
        context = F.shiftrightunsigned("gram", BITS) if order > 1 else F.lit(0).cast("long")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = level.join(F.broadcast(discounts(level)), "key")  # a row per language
        rows = rows.select("key", "gram", "n", cut.alias("cut"), context.alias("context"), suffix(order - 1).alias("last"))
        same = Window.partitionBy("key", "context")
        total, held = F.sum("n").over(same), F.sum("cut").over(same)
        rows = rows.withColumns({"total": total, "held": held, "followers": F.count("*").over(same)})
        if lower is None:
            below = 1 / F.col("followers")
        else:
            rows, below = rows.join(lower, ["key", "last"]), F.col("below")
        chance = (F.col("n") - F.col("cut") + F.col("held") * below) / F.col("total")
        lower = rows.select("key", F.col("gram").alias("last"), chance.alias("below"))
    lang = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30))
    return lower.select(lang.alias("lang"), F.col("last").alias("gram"), F.log("below").alias("logp"))


def build_models(counts: DataFrame) -> DataFrame:
    """(lang, shard, size, grams, logp): sorted arrays as bytes."""
    shards = 1 + counts.count() // SHARD_GRAMS

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("gram")
        grams, logp = rows["gram"].to_numpy(np.int64).tobytes(), rows["logp"].to_numpy(np.float32).tobytes()
        first = {"lang": [rows["lang"].iloc[0]], "shard": [rows["shard"].iloc[0]], "size": [len(grams) + len(logp)]}
        return pd.DataFrame({**first, "grams": [grams], "logp": [logp]})

    dealt = kneser_ney(counts).withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)).cast("int"))
    return dealt.groupBy("lang", "shard").applyInPandas(run, "lang string, shard int, size long, grams binary, logp binary")


BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


NAMES = [x.split()[0] for x in BASE.split(", ")]
Shards = dict[str | None, list[tuple[bytes, bytes]]]


def log_probabilities(grams: np.ndarray, shards: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Of each gram, 0 where no shard has it."""
    out = np.zeros(len(grams), np.float32)
    for known, logp in shards:
        known, logp = np.frombuffer(known, np.int64), np.frombuffer(logp, np.float32)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        out += np.where(known[at] == grams, logp[at], np.float32(0))
    return out


def score(docs: DataFrame, shards: Shards) -> DataFrame:
    """(doc_id, text_hash, lang, base columns, total) with the texts' log probability in these shards.

    It is NULL where the layout rules fail or the language has no shard here.
    """
    shared = docs.sparkSession.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                langs, texts = some.column(2).to_pylist(), some.column(3).to_pylist()
                base = layout(texts)
                found = np.full(some.num_rows, np.nan)
                for k in np.flatnonzero(~base["base_failed"]).tolist():
                    if langs[k] in shared.value:
                        logp = log_probabilities(ngrams(symbols_of(texts[k])), shared.value[langs[k]])
                        found[k] = logp.sum(dtype=np.float64)
                parts = [some.column(0), some.column(1), some.column(2), *(pa.array(base[n]) for n in NAMES)]
                parts.append(pa.array(found, from_pandas=True))
                yield pa.RecordBatch.from_arrays(parts, ["doc_id", "text_hash", "lang", *NAMES, "total"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "lang", "text")
    return rows.mapInArrow(run, f"doc_id long, text_hash long, lang string, {BASE}, total double")


def score_in_passes(docs: DataFrame, models: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(doc_id, text_hash, lang, base columns, score). Each pass holds shards of ``broadcast_bytes``, or one that is larger."""
    sizes = models.select("lang", "shard", "size").collect()  # a row per shard
    passes: list[list[tuple[str | None, int]]] = [[]]
    room = broadcast_bytes
    for r in sorted(sizes, key=lambda r: (r.lang is not None, r.lang or "", r.shard)):
        if passes[-1] and r.size > room:
            passes.append([])
            room = broadcast_bytes
        passes[-1].append((r.lang, r.shard))
        room -= r.size
    found = []
    for wanted in passes:
        shards: Shards = {}
        if wanted:
            own = [F.col("lang").eqNullSafe(F.lit(lang)) & (F.col("shard") == shard) for lang, shard in wanted]
            either = own[0]
            for one in own[1:]:
                either = either | one
            for r in models.where(either).collect():
                shards.setdefault(r.lang, []).append((bytes(r.grams), bytes(r.logp)))
        found.append(stored(score(docs, shards), "scores"))
    rows = found[0]
    if len(found) > 1:  # equal texts have equal sums, so one row of each pass tells
        summed = None
        for k, part in enumerate(found):
            part = part.groupBy("lang", "text_hash").agg(F.max("total").alias("part")).withColumn("k", F.lit(k))
            summed = part if summed is None else summed.unionByName(part)
        summed = summed.groupBy(F.col("lang").alias("its_lang"), F.col("text_hash").alias("its_hash")).agg(
            F.aggregate(  # in the order of the passes
                F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("k", "part")))),
                F.lit(None).cast("double"),
                lambda sofar, x: F.coalesce(sofar, F.lit(0.0)) + x["part"],
            ).alias("total")
        )
        own = F.col("lang").eqNullSafe(F.col("its_lang")) & F.col("text_hash").eqNullSafe(F.col("its_hash"))
        rows = rows.drop("total").join(summed, own, "left")
    return rows.select("doc_id", "text_hash", "lang", *NAMES, (-F.col("total") / F.col("n_words")).alias("score"))


def centre_and_width(scores: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Of sorted scores and how often each occurs: the middle of the shortest stretch with half of all, and the width.

    The width is the median distance from there on the narrower side, times 1.9 (as wide as half the distance between
    the 10th and 90th percentile of a normal distribution). A third of bad scores on one side moves neither.
    """
    upto, total = np.cumsum(times), int(times.sum())
    ends = np.searchsorted(upto, upto - times + (total + 1) // 2)
    starts = np.flatnonzero(ends < len(scores))
    ends = ends[starts]
    length = scores[ends] - scores[starts]
    best = length <= length.min() + 1e-9
    centre = float(((scores[ends] + scores[starts])[best] / 2).mean())

    def typical(side: np.ndarray) -> float:
        away, n = np.abs(scores[side] - centre), times[side]
        order = np.argsort(away)
        return float(away[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)])

    width = 1.9 * min(typical(scores <= centre), typical(scores >= centre))
    if total < FEW:  # too few to tell bad ones from the others
        low, high = scores[np.searchsorted(upto, [0.1 * total, 0.9 * total])]
        width = max(width, (high - low) / 2)
    return centre, max(width, 0.01)


def spread(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, middle, width, n) of the scores of different texts, by counts.

    Scores are rounded to a thousandth before, so a group is as many rows as it has different rounded scores.
    """

    def run(bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("s")
        middle, width = centre_and_width(bins["s"].to_numpy(float), bins["n"].to_numpy(np.int64))
        found = {"middle": [middle], "width": [width], "n": [int(bins["n"].sum())]}
        return pd.DataFrame({**{k: bins[k].iloc[:1].tolist() for k in keys}, **found})

    bins = scores.groupBy(*keys, F.round("score", 3).alias("s")).agg(F.count("*").alias("n"))
    types = {"lang": "string", "octave": "long"}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", middle double, width double, n long"
    return bins.groupBy(*keys).applyInPandas(run, schema)


def judge(
    docs: DataFrame,
    below: float = 5.0,
    above: float = 5.0,
    band_rows: int = 200,
    broadcast_bytes: int = 256 << 20,
) -> DataFrame:
    """One row per document: doc_id, text_hash, lang, base columns, score, kept."""
    models = stored(build_models(stored(count_ngrams(docs), "ngrams")), "models")
    scored = score_in_passes(docs, models, broadcast_bytes).withColumn("octave", F.floor(F.log2(F.col("n_words") + F.lit(1.0))))
    clean = scored.where("not base_failed and score is not null")
    clean = clean.select("lang", "octave", "text_hash", "score").distinct()
    of_length = spread(clean, ["lang", "octave"]).where(F.col("n") >= band_rows)
    of_lang = spread(clean, ["lang"])
    fine = of_length.select(
        F.col("lang").alias("l1"), F.col("octave").alias("o1"), F.col("middle").alias("m1"), F.col("width").alias("w1")
    )
    wide = of_lang.select(F.col("lang").alias("l2"), F.col("middle").alias("m2"), F.col("width").alias("w2"))
    bands = F.broadcast  # both are as small as languages times lengths
    joined = scored.join(bands(fine), F.col("lang").eqNullSafe(F.col("l1")) & (F.col("octave") == F.col("o1")), "left")
    joined = joined.join(bands(wide), F.col("lang").eqNullSafe(F.col("l2")), "left")
    away = (F.col("score") - F.coalesce("m1", "m2")) / F.coalesce("w1", "w2")
    inside = F.coalesce((away >= -below) & (away <= above), F.lit(False))
    return joined.select(
        "doc_id",
        "text_hash",
        "lang",
        *NAMES,
        "score",
        away.alias("spreads_away"),
        (~F.col("base_failed") & inside).alias("kept"),
    )


def keep_inside(docs: DataFrame, **how) -> DataFrame:
    """The documents that are kept, their columns as they are. Equal rows are judged alike, so ids and text hash tell."""
    out = judge(docs, **how).where("not kept").select("doc_id", "text_hash").distinct()
    gone = stored(out.toDF("gone_id", "gone_hash"), "rejected")  # its true size decides whether it is broadcast
    own = docs["doc_id"].eqNullSafe(gone["gone_id"]) & F.xxhash64(docs["text"]).eqNullSafe(gone["gone_hash"])
    return docs.join(gone, own, "left_anti")
