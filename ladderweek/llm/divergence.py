"""How far the sources of each language are from one another, and which terms set a source apart.

In-mapper stripes: every task folds whole documents into hash stripes, term -> (documents that hold it, occurrences by
source), and spills them when they hold many cells. Stripes of one (lang, term) meet sorted and are merged as they pass
by, so a term has one row per spill there however frequent it is. Terms in few documents go after that merge. The
merged stripes are dealt over blocks of terms of one language, and each block emits its share of every divergence.

A term is a run of ASCII letters and non-ASCII code points, A-Z lower-cased. A group's share of a term is the integer
p = 1 + floor(10^9 * (count + 5) / (n + 5 * v)), n the group's occurrences of kept terms and v their number; a
divergence is the sum of abs(p - q). Everything is whole numbers.

Defined results: NULL text, lang or source is ''; a group without terms is a group; repeated rows count each time; an
empty table gives no row; ties rank by the item's UTF-8 bytes. Other columns of the input are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import release, stored, text_or_empty

SCALE = 1_000_000_000
SMOOTHING = 5
#: A to Z become lower case, other ASCII that is no letter a blank; bytes of non-ASCII code points stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
STRIPE = "lang string, term string, n_docs long, sources array<string>, counts array<long>"
FIELDS = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("n_docs", pa.int64()),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)
#: The stripe of this term, which no document holds, counts a language's documents by source.
DOCUMENTS = b""
BATCH = 20_000


def fold(stripes: dict, lang: str, source: str, text: bytes) -> int:
    """Adds one document to the stripes, (lang, term) -> [documents, {source: occurrences}]; the number of new cells."""
    new = 0
    found = Counter(text.translate(FOLD).split())
    found[DOCUMENTS] = 1
    own = stripes.setdefault(lang, {})
    for term, n in found.items():
        stripe = own.get(term)
        if stripe is None:
            own[term] = [1, {source: n}]
            new += 1
        else:
            stripe[0] += 1
            cells = stripe[1]
            if source in cells:
                cells[source] += n
            else:
                cells[source] = n
                new += 1
    return new


def written(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (lang, term bytes, documents, {source: occurrences})."""
    langs, terms, n_docs, cells = zip(*rows, strict=True)
    at = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(c) for c in cells], out=at[1:])
    at = pa.array(at)
    sources = pa.ListArray.from_arrays(at, pa.array([s for c in cells for s in c], pa.string()))
    counts = pa.ListArray.from_arrays(at, pa.array([n for c in cells for n in c.values()], pa.int64()))
    names = pa.array(terms, pa.binary()).cast(pa.string())
    columns = [pa.array(langs, pa.string()), names, pa.array(n_docs, pa.int64()), sources, counts]
    return pa.RecordBatch.from_arrays(columns, schema=FIELDS)


def partial_stripes(docs: DataFrame, spill_cells: int) -> DataFrame:
    """Stripes of each task, spilled whenever they hold ``spill_cells`` cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        stripes: dict = {}
        cells = 0

        def spill() -> Iterator[pa.RecordBatch]:
            rows = []
            for lang, own in stripes.items():
                for term, (n, by_source) in own.items():
                    rows.append((lang, term, n, by_source))
                    if len(rows) == BATCH:
                        yield written(rows)
                        rows.clear()
            if rows:
                yield written(rows)
            stripes.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                lang, source, text = (c.to_pylist() for c in batch.slice(at, 256).columns)
                for a, b, t in zip(lang, source, text, strict=True):
                    cells += fold(stripes, a, b, t)
                    if cells >= spill_cells:
                        yield from spill()
                        cells = 0
        yield from spill()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(*named, text_or_empty().cast("binary").alias("text")).mapInArrow(run, STRIPE)


def run_starts(rows: pa.Table) -> np.ndarray:
    """Where the stripes of another (lang, term) begin among sorted ones."""
    n = rows.num_rows
    other = np.ones(n, bool)
    if n > 1:
        differ = [pc.not_equal(rows.column(c).slice(1), rows.column(c).slice(0, n - 1)) for c in ("lang", "term")]
        other[1:] = pc.or_(*differ).to_numpy(zero_copy_only=False) if n > 1 else other[1:]
    return np.flatnonzero(other)


def merge(rows: pa.Table, least_docs: int) -> pa.RecordBatch:
    """One stripe per (lang, term) of sorted stripes; terms in fewer documents are left out."""
    starts = run_starts(rows)
    n_docs = np.add.reduceat(rows.column("n_docs").to_numpy(), starts)
    empty = pc.equal(rows.column("term").take(pa.array(starts)), "").to_numpy(zero_copy_only=False)
    stays = (n_docs >= least_docs) | empty
    sizes = np.diff(np.append(starts, rows.num_rows))
    some = rows.filter(pa.array(np.repeat(stays, sizes))).combine_chunks()
    n = int(stays.sum())
    lists = some.column("sources").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    of_row = np.repeat(np.arange(n), sizes[stays])
    of_cell = np.repeat(of_row, lists.value_lengths().to_numpy(zero_copy_only=False))
    named = lists.flatten().dictionary_encode()
    counts = pc.list_flatten(some.column("counts")).to_numpy()
    wide = max(1, len(named.dictionary))
    cell = of_cell * wide + named.indices.to_numpy()
    order = np.argsort(cell, kind="stable")
    cells, first = np.unique(cell[order], return_index=True)
    sums = np.add.reduceat(counts[order], first) if len(first) else counts
    at = pa.array(np.searchsorted(cells, np.arange(n + 1) * wide).astype(np.int32))
    keys = rows.select(["lang", "term"]).take(pa.array(starts[stays])).combine_chunks()
    one = [keys.column(c).combine_chunks() for c in ("lang", "term")]
    one = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in one]
    sources = pa.ListArray.from_arrays(at, named.dictionary.take(pa.array(cells % wide)))
    return pa.RecordBatch.from_arrays(
        [*one, pa.array(n_docs[stays]), sources, pa.ListArray.from_arrays(at, pa.array(sums, pa.int64()))], schema=FIELDS
    )


def merged_stripes(partial: DataFrame, least_docs: int) -> DataFrame:
    """One stripe per (lang, term) in at least ``least_docs`` documents, and those that count documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last term's stripes: more of them may follow
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            cut = int(run_starts(rows)[-1])
            if cut:
                merged = merge(rows.slice(0, cut), least_docs)
                if merged.num_rows:
                    yield merged
            rest = rows.slice(cut)
        if rest is not None:
            yield merge(rest, least_docs)

    met = partial.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return met.mapInArrow(run, STRIPE)


def shares(counts: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """p of counts, whole numbers without rounding at any size."""
    if int(counts.max(initial=0)) > 9_000_000_000:
        counts, n = counts.astype(object), n.astype(object)
    return 1 + SCALE * (counts + SMOOTHING) // (n + SMOOTHING * v)


def block_divergences(stripes: pd.DataFrame, groups: pd.DataFrame, part: int, width: int, top: int) -> pd.DataFrame:
    """What one block of a language's terms adds: (source, part, item, value).

    For the sources of chunk ``part``: the sum of abs(p - q) against every other source, and their ``top`` terms against
    the language. The dense table of shares is made for some terms at a time.
    """
    groups = groups.sort_values("source", kind="stable")
    names, n, v = groups["source"].tolist(), groups["n"].to_numpy(np.int64), int(groups["v"].iloc[0])
    at = {s: k for k, s in enumerate(names)}
    mine = range(part * width, min(len(names), (part + 1) * width))
    apart = np.zeros((len(mine), len(names)), np.int64)
    best: list[list[tuple]] = [[] for _ in mine]
    terms = [t.encode() for t in stripes["term"]]
    some = max(1, 1_000_000 // max(1, len(names)))
    for first in range(0, len(terms), some):
        rows = stripes.iloc[first : first + some]
        counts = np.zeros((len(rows), len(names)), np.int64)
        for k, (sources, numbers) in enumerate(zip(rows["sources"], rows["counts"], strict=True)):
            counts[k, [at[s] for s in sources]] = numbers
        p = shares(counts, n[None, :], v)
        q = shares(counts.sum(1), np.array([n.sum()]), v)
        for i, k in enumerate(mine):
            apart[i] += np.abs(p - p[:, k : k + 1]).sum(0).astype(np.int64)
            ahead = np.flatnonzero((counts[:, k] > 0) & (p[:, k] > q))
            found = [(-int(p[r, k] - q[r]), terms[first + r]) for r in ahead.tolist()]
            best[i] = heapq.nsmallest(top, best[i] + found)
    out = [(names[k], "pair", names[t], int(apart[i, t])) for i, k in enumerate(mine) for t in range(len(names)) if t != k]
    out += [(names[k], "term", term.decode(), -less) for i, k in enumerate(mine) for less, term in best[i]]
    return pd.DataFrame(out, columns=["source", "part", "item", "value"])


def audit(
    docs: DataFrame, least_docs: int = 30, top: int = 50, spill_cells: int = 400_000, block_cells: int = 65_536, width: int = 512
) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for each other source, ``term`` rows for the ``top`` terms.

    ``spill_cells`` bounds a task's stripes, ``block_cells`` the cells of a block of terms, ``width`` the sources whose
    pairs one task sums. Only groups and blocks are joined by language; neither grows with the documents of a group.
    """
    merged = stored(merged_stripes(partial_stripes(docs, spill_cells), least_docs), "stripes")
    kept, counted = merged.where("term <> ''"), merged.where("term = ''")
    cells = lambda df, c: df.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select(
        "lang", F.col("x.sources").alias("source"), F.col("x.counts").alias(c)
    )
    n = cells(kept, "c").groupBy("lang", "source").agg(F.sum("c").alias("n"))
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = cells(counted, "n_docs").join(n, ["lang", "source"], "left").join(v, "lang", "left")
    groups = stored(groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in "nv"]), "groups")
    langs = groups.groupBy("lang").agg(F.first("v").alias("v"), F.count("*").alias("s"))
    per_block = F.greatest("s", F.ceil(F.lit(block_cells) / F.col("s")))
    langs = langs.select(
        "lang",
        F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / per_block)).alias("blocks"),
        F.ceil(F.col("s") / width).alias("parts"),
    )
    number = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    dealt = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    dealt = dealt.select("lang", "block", number("parts").alias("chunk"), "term", "sources", "counts")
    beside = groups.join(langs, "lang").select("*", number("blocks").alias("block"))
    beside = beside.select("lang", "block", number("parts").alias("chunk"), "source", "n", "v")

    def run(key: tuple, stripes: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        found = block_divergences(stripes, groups, int(key[2]), width, top)
        found.insert(0, "lang", key[0])
        return found

    by = ("lang", "block", "chunk")
    found = dealt.groupBy(*by).cogroup(beside.groupBy(*by)).applyInPandas(
        run, "lang string, source string, part string, item string, value long"
    )
    found = stored(found, "divergences")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", place)
    terms = found.where("part = 'term'").withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("lang", "source", "part", "item", "value", "rank").unionByName(
        terms.select("lang", "source", "part", "item", "value", "rank")
    )
