"""Quality classifier by co-training on two views of a document.

One view is the text's content: which words it holds, hashed. The other is the page around it: language, source,
size, and how lines, letters, signs and repeats are laid out. Both views of every document are worked out once and stored.
A logistic model per view is fitted to a sample of labelled documents. Over several rounds both views score all unlabelled
documents; those that one is sure of, and the other does not contradict, get its pseudo-label, chosen anew each round, and the other
view is fitted again with them. Labelled documents kept aside calibrate both views and their combination, which scores all.

Models are fitted in the driver to bounded samples of labelled rows: at most ``labelled_rows`` documents with a label, and of
the documents with a pseudo-label at most ``taken`` of each view and class, drawn by a hash of the id; both are parameters. What
is scored, searched and labelled in a round is every unlabelled document. A document is good if its quality label is 1
and it is not labelled toxic. Rounds run while the result is being built.

Defined results: a NULL text is empty; NULL language or source is a value of its own; of repeated labels the lower
quality and the higher toxicity count, NULL labels are left out; without labels of both kinds every score is 0.5 and every
document kept; repeated rows get the same scores; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import held, release, stored

TEXT_BITS = 18
N_META = 14 + 16 + 64
UPPER, DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
SIGNS = b"#*$%&|<>!?@^~_=+{}[]\\"


class WordSlots(dict):
    """Word -> slots of the hashed text view: the word and its first 4, 5 and 6 bytes; forgets beyond 100,000 words."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 100_000:
            self.clear()
        bare = word.strip(b".,;:")
        forms = [bare, *(b"^" + bare[:k] for k in (4, 5, 6) if len(bare) > k)]
        out = self[word] = tuple(xxhash.xxh32_intdigest(x, 7) & ((1 << TEXT_BITS) - 1) for x in forms)
        return out


def text_view(text: bytes, slots: WordSlots) -> np.ndarray:
    """Slots of the distinct words and their beginnings."""
    found = set(chain.from_iterable(map(slots.__getitem__, set(text.lower().split()))))
    return np.fromiter(found, np.int32, len(found))


def page_view(text: bytes, lang: str | None, source: str | None) -> np.ndarray:
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n, chars = max(1, len(words)), max(1, len(text))
    count = lambda some: len(text) - len(text.translate(None, some))
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    dense = [
        np.log1p(len(text)) / 10,
        np.log1p(len(words)) / 8,
        min(30.0, len(text) / n) / 10,
        len(set(words)) / n,
        np.log1p(len(lines)) / 4,
        1 - len(set(lines)) / max(1, len(lines)),
        runs / n,
        count(UPPER) / chars * 4,
        count(DIGITS) / chars * 4,
        min(1.0, 10 * count(SIGNS) / chars),
        min(1.0, 10 * text.count(b"|") / chars),
        text.count(b".") / n,
        float(len(words) < 20),
        1.0,
    ]
    out = np.zeros(N_META, np.float32)
    out[:14] = dense
    out[14 + xxhash.xxh32_intdigest(repr(lang), 1) % 16] = 1
    out[30 + xxhash.xxh32_intdigest(repr(source), 2) % 64] = 0.5
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Rows:
    """Documents as seen by both views; the text view is a ragged list of slots laid end to end, document by document."""

    slots: np.ndarray
    owner: np.ndarray
    meta: np.ndarray

    def blocks(self, docs: int = 128) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First document, slots and owners of so many documents at a time: what is worked out per slot stays small."""
        firsts = np.arange(0, len(self.meta), docs)
        ends = np.searchsorted(self.owner, np.append(firsts, len(self.meta)).astype(self.owner.dtype)).tolist()
        for first, lo, hi in zip(firsts.tolist(), ends, ends[1:], strict=False):
            yield first, self.slots[lo:hi], self.owner[lo:hi]

    def text_scores(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.meta))
        for first, slots, owner in self.blocks():
            some = out[first : first + 128]
            some += np.bincount(owner - first, w[slots], len(some))
        return w[-1] + out


def labels_of(parts: list[Rows], y: np.ndarray) -> Iterator[tuple[Rows, np.ndarray, int]]:
    """Each part with its own labels and the number of its first row among all."""
    first = 0
    for part in parts:
        yield part, y[first : first + len(part.meta)], first
        first += len(part.meta)


def telling(parts: list[Rows], y: np.ndarray, least: float = 4.0) -> np.ndarray:
    """Slots that occur in good and in bad documents unevenly, by ``least`` standard deviations or more."""
    size = 1 << TEXT_BITS
    bad, every = np.zeros(size), np.zeros(size, np.int64)
    for part, of_part, _ in labels_of(parts, y):
        for _, slots, owner in part.blocks(1024):
            bad += np.bincount(slots, (of_part == 0)[owner], size)
            every += np.bincount(slots, minlength=size)
    share = (y == 0).mean()
    expected = every * share
    spread = np.sqrt(np.maximum(every * share * (1 - share) * (1 - every / max(1, len(y))), 1e-9))
    return np.flatnonzero((every > 2) & (np.abs(bad - expected) >= least * spread))


def fit_text(parts: list[Rows], y: np.ndarray, weight: np.ndarray, steps: int = 200, l2: float = 0.05) -> np.ndarray:
    """Weights of the telling slots and, last, the bias: logistic loss with L2, by steps scaled per slot.

    The rows of all parts are never laid together, only their telling slots.
    """
    size = 1 << TEXT_BITS
    chosen = telling(parts, y)
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    kept: list[np.ndarray] = [np.zeros(0, np.int32)]
    owners: list[np.ndarray] = [np.zeros(0, np.int32)]
    for part, _, first in labels_of(parts, y):
        for _, slots, owner in part.blocks(1024):
            at = place[slots]
            mine = at >= 0
            kept.append(at[mine])
            owners.append((owner[mine] + first).astype(np.int32))
    small = Rows(np.concatenate(kept), np.concatenate(owners), np.zeros((len(y), 0)))
    del kept, owners
    w, seen, moment = (np.zeros(len(chosen) + 1) for _ in range(3))
    for step in range(1, steps + 1):
        error = weight * (sigmoid(small.text_scores(w)) - y)
        gradient = np.append(np.bincount(small.slots, error[small.owner], len(chosen)), error.sum())
        gradient[:-1] += l2 * w[:-1]
        moment = 0.8 * moment + 0.2 * gradient
        seen = 0.95 * seen + 0.05 * gradient**2
        scaled = moment / (1 - 0.8**step) / (np.sqrt(seen / (1 - 0.95**step)) + 1e-6)
        w -= 0.2 * (1 - step / (steps + 1)) * scaled
    out = np.zeros(size + 1)
    out[chosen], out[-1] = w[:-1], w[-1]
    return out


def fit_dense(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 0.1, steps: int = 15) -> np.ndarray:
    """Logistic weights by Newton steps."""
    w = np.zeros(x.shape[1])
    x = x.astype(float)
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = x.T @ (x * (weight * p * (1 - p))[:, None]) + l2 * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (weight * (p - y)) + l2 * w)
    return w


def both_views(text_logit: np.ndarray, meta_logit: np.ndarray) -> np.ndarray:
    """What the combination is fitted to: a document must look good in both views."""
    text_logit, meta_logit = np.clip(text_logit, -6, 6), np.clip(meta_logit, -6, 6)
    return np.stack([text_logit, meta_logit, np.minimum(text_logit, meta_logit), np.ones(len(text_logit))], 1)


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    combine: np.ndarray  # of text logit, page logit, the lower of both, 1

    def scores(self, text_logit: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        meta_logit = meta @ self.meta
        return sigmoid(text_logit), sigmoid(meta_logit), sigmoid(both_views(text_logit, meta_logit) @ self.combine)


def views_of(texts: list[bytes | None], langs: list, sources: list) -> tuple[list[np.ndarray], np.ndarray]:
    slots = held("word_slots", WordSlots)
    text = [text_view(t or b"", slots) for t in texts]
    return text, np.stack([page_view(t or b"", a, b) for t, a, b in zip(texts, langs, sources, strict=True)])


def both_views_of(docs: DataFrame) -> DataFrame:
    """(doc_id, slots, meta): the views of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                text, meta = views_of(*(some.column(i).to_pylist() for i in (1, 2, 3)))
                sizes = np.zeros(len(text) + 1, np.int32)
                np.cumsum([len(x) for x in text], out=sizes[1:])
                slots = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(text).astype(np.int32)))
                at_meta = pa.array(np.arange(len(text) + 1, dtype=np.int32) * N_META)
                dense = pa.ListArray.from_arrays(at_meta, pa.array(meta.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([some.column(0), slots, dense], ["doc_id", "slots", "meta"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), "lang", "source")
    return own.mapInArrow(run, "doc_id long, slots array<int>, meta array<float>")


def as_rows(slots: pa.Array, meta: pa.Array) -> Rows:
    lens = pc.list_value_length(slots).to_numpy(zero_copy_only=False)
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (slots, meta)]
    return Rows(flat[0], np.repeat(np.arange(len(lens), dtype=np.int32), lens), flat[1].reshape(-1, N_META).astype(float))


def sure(mine: np.ndarray, other: np.ndarray) -> np.ndarray:
    """1 or 0 where one view is sure and the other does not contradict, else -1; both are logits."""
    return np.where((mine < -2) & (other < 1), 0, np.where((mine > 2) & (other > -1), 1, -1))


def pseudo_labels(views: DataFrame, labelled: DataFrame, text: np.ndarray, meta: np.ndarray) -> DataFrame:
    """(doc_id, by, good): every unlabelled document that a view (``by`` 0 text, 1 page) is sure of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            if batch.num_rows:
                rows = as_rows(batch.column(1), batch.column(2))
                by_text, by_page = rows.text_scores(text), rows.meta @ meta
                for by, label in enumerate((sure(by_text, by_page), sure(by_page, by_text))):
                    at = np.flatnonzero(label >= 0)
                    columns = [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), by, np.int32)), pa.array(label[at].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "by", "good"])

    known = views.where("doc_id is not null")
    found = known.mapInArrow(run, "doc_id long, by int, good int")
    return found.join(labelled.select("doc_id"), "doc_id", "left_anti").groupBy("doc_id", "by").agg(F.min("good").alias("good"))


def drawn(rows: DataFrame, most: int) -> list:
    """At most ``most`` rows, by a hash of the id."""
    return rows.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(most).collect()


def fetched(views: DataFrame, chosen: list[tuple[int, int]]) -> tuple[Rows, np.ndarray]:
    """Views and labels of the chosen (doc_id, good), one row an id; as many as the bounds of the samples allow."""
    wanted = F.broadcast(views.sparkSession.createDataFrame(chosen, "doc_id long, good int"))
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("slots", "meta")))
    mine = views.join(wanted, "doc_id").withColumn("one", one).where("one = 1")
    got = mine.select("doc_id", "good", "slots", "meta").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").toArrow()
    good = np.array(got.column("good").to_pylist())
    slots, meta = (got.column(c).combine_chunks() for c in ("slots", "meta"))
    del got
    pa.default_memory_pool().release_unused()
    return as_rows(slots, meta), good


def co_train(rows: Rows, label: np.ndarray, rounds: int, ask) -> Model | None:
    """Models of the labelled rows and of what ``ask(text weights, page weights)`` labels.

    It returns, for the text view's labels and for the page view's, (rows, labels). A fifth of the labelled rows calibrates
    and is not fitted to.
    """
    aside = np.arange(0, len(label), 5)
    fitted = np.setdiff1d(np.arange(len(label)), aside)
    if len(set(label[fitted].tolist())) < 2 or len(set(label[aside].tolist())) < 2:
        return None

    def part(at: np.ndarray) -> Rows:
        number = np.full(len(label), -1, np.int32)
        number[at] = np.arange(len(at), dtype=np.int32)
        owner = number[rows.owner]
        mine = owner >= 0
        return Rows(rows.slots[mine], owner[mine], rows.meta[at])

    base, truth = part(fitted), label[fitted].astype(float)

    def fit_view(more: tuple[Rows, np.ndarray] | None, text: bool) -> np.ndarray:
        parts, y = ([base], truth) if more is None else ([base, more[0]], np.append(truth, more[1]))
        weight = np.where(np.arange(len(y)) < len(truth), 1.0, 0.5)
        return fit_text(parts, y, weight) if text else fit_dense(np.concatenate([p.meta for p in parts]), y, weight)

    w_text, w_meta = fit_view(None, True), fit_view(None, False)
    for _ in range(rounds):
        by_text, by_page = ask(w_text, w_meta)
        w_text, w_meta = fit_view(by_page, True), fit_view(by_text, False)
    views = both_views(rows.text_scores(w_text), rows.meta @ w_meta)
    good = label[aside].astype(float)
    return Model(w_text, w_meta, fit_dense(views[aside], good, np.ones(len(good)), l2=1.0))


def fit(views: DataFrame, labels: DataFrame, labelled_rows: int, taken: int, rounds: int) -> Model | None:
    clean = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("good")
    )
    ids = views.select("doc_id").where("doc_id is not null").distinct()
    chosen = [(r.doc_id, r.good) for r in drawn(ids.join(clean, "doc_id"), labelled_rows)]
    if not chosen:
        return None

    def ask(text: np.ndarray, meta: np.ndarray) -> list[tuple[Rows, np.ndarray] | None]:
        found = stored(pseudo_labels(views, clean, text, meta), "pseudo")
        given = []
        for by in (0, 1):
            picked = [(r.doc_id, r.good) for good in (0, 1) for r in drawn(found.where((F.col("by") == by) & (F.col("good") == good)), taken)]
            given.append(fetched(views, picked) if picked else None)
        return given

    return co_train(*fetched(views, chosen), rounds, ask)


def classify(
    docs: DataFrame, labels: DataFrame, labelled_rows: int = 8_000, taken: int = 500, rounds: int = 3, keep_from: float = 0.5
) -> DataFrame:
    """(doc_id, text_score, page_score, score, kept) for every document, from its stored views."""
    views = stored(both_views_of(docs), "views")
    model = fit(views, labels, labelled_rows, taken, rounds)
    if model is None:
        half = [F.lit(0.5).alias(c) for c in ("text_score", "page_score", "score")]
        return views.select("doc_id", *half, F.lit(True).alias("kept"))
    shared = shared_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = Model(*shared.value)
        for batch in batches:
            if batch.num_rows:
                rows = as_rows(batch.column(1), batch.column(2))
                found = model.scores(rows.text_scores(model.text), rows.meta)
                parts = [batch.column(0), *map(pa.array, found), pa.array(found[2] >= keep_from)]
                yield pa.RecordBatch.from_arrays(parts, ["doc_id", "text_score", "page_score", "score", "kept"])

    return views.mapInArrow(run, "doc_id long, text_score double, page_score double, score double, kept boolean")


def shared_model(model: Model):
    return SparkSession.active().sparkContext.broadcast((model.text, model.meta, model.combine))  # of fixed size


def keep_good(
    docs: DataFrame, labels: DataFrame, labelled_rows: int = 8_000, taken: int = 500, rounds: int = 3, keep_from: float = 0.5
) -> DataFrame:
    """The documents with a score of ``keep_from`` or more, their columns as they are."""
    model = fit(stored(both_views_of(docs), "views"), labels, labelled_rows, taken, rounds)
    if model is None:
        return docs
    shared = shared_model(model)
    at = [docs.columns.index(c) for c in ("text", "lang", "source")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                columns = [batch.column(i) for i in at]
                text, meta = views_of(columns[0].cast(pa.binary()).to_pylist(), columns[1].to_pylist(), columns[2].to_pylist())
                logit = np.array([model.text[x].sum() for x in text]) + model.text[-1]
                yield batch.filter(pa.array(model.scores(logit, meta.astype(float))[2] >= keep_from))

    return docs.mapInArrow(run, docs.schema)
