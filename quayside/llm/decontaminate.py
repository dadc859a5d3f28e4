"""Benchmark decontamination: a distributed positional inverted index over the training documents.

A term is three consecutive words (fewer in shorter items).  The index is dealt by document: for every
document the places of its terms, kept for terms the benchmark asks for.  It is stored once; the number
of places of a term over all documents orders the terms of each benchmark window from rare to common.
Each index part then takes the places of a window's rarest term, shifts them by the term's offset, and
keeps those where all other terms of the window stand at their own offsets: exact phrases.  With
``slack``, the other terms may be that many words off: proximity matches.

Windows are sent to the index parts in blocks of ``WINDOWS_PER_BLOCK``, so what is broadcast is bounded
for any benchmark.  While the benchmark has at most ``TERMS_IN_FILTER`` terms the index leaves out all
others; beyond that it keeps every term of every document, with the same result.

Null texts have no words; an item without words has no windows; items with equal windows are all named;
null item ids are left out of lists; repeated rows count as documents of their own; empty tables work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..settings import materialize, scratch
from .arrays import WORDS, groups, mix, shingles, texts_of, words_of
from .filters import make_filter, passes
from .shared import batch, by_batch, numbered, table

WINDOW = 10
TERM = 3
WINDOWS_PER_BLOCK = 100_000


def term_offsets(n: int) -> list[int]:
    """Offsets of terms that cover n words."""
    return [0] if n <= TERM else [*range(0, n - TERM, TERM), n - TERM]


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """window, n_words, item, and its terms with their offsets: one row per window of each item."""

    def work(rows):
        items = rows.column("item_id").to_pylist()
        data, offsets = texts_of(rows.column("text"))
        for i, j in groups(offsets):
            words, first = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], WORDS)
            for k in range(j - i):
                own = words[first[k] : first[k + 1]]
                n = min(width, len(own))
                if not n:
                    continue
                whole, terms, at = shingles(own, n), shingles(own, min(n, TERM)), term_offsets(n)
                m = len(whole)
                yield batch(
                    window=pa.array(whole.view(np.int64)), n_words=pa.array([n] * m, pa.int32()),
                    item=pa.array([items[i + k]] * m, pa.string()),
                    terms=pa.array([[{"term": t, "offset": o} for t, o in zip(terms.view(np.int64)[[s + o for o in at]].tolist(), at)]
                                    for s in range(m)], pa.list_(pa.struct([("term", pa.int64()), ("offset", pa.int32())]))),
                )

    return by_batch(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"), work,
        "window long, n_words int, item string, terms array<struct<term: long, offset: int>>")


def index(docs: DataFrame, widths: list[int], wanted: np.ndarray) -> DataFrame:
    """Per document: n_words, and its terms (8 bytes each, in order) with their places (4 bytes each); of all terms those
    that pass the filter ``wanted``."""
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def work(rows):
        ids = rows.column("doc_id")
        data, offsets = texts_of(rows.column("text"))
        for i, j in groups(offsets):
            words, first = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], WORDS)
            found, place = [], []
            for width in widths:
                terms = shingles(words, width)
                at = np.flatnonzero(passes(known.value, terms))
                found.append(terms[at])
                place.append(at)
                # a term must end in the document it begins in
                doc = np.searchsorted(first, at, "right") - 1
                inside = at + width <= first[doc + 1]
                found[-1], place[-1] = found[-1][inside], at[inside]
            terms, at = np.concatenate(found), np.concatenate(place)
            doc = np.searchsorted(first, at, "right") - 1
            order = np.lexsort((at, terms, doc))
            terms, at, doc = terms[order], at[order], doc[order]
            bounds = np.searchsorted(doc, np.arange(j - i + 1))
            own = (at - first[doc]).astype("<i4")
            yield batch(
                doc_id=ids.slice(i, j - i), n_words=np.diff(first).astype(np.int64),
                terms=pa.array([terms[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                places=pa.array([own[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
            )

    return by_batch(docs.select("doc_id", "text"), work, "doc_id long, n_words long, terms binary, places binary")


def term_counts(stored: DataFrame) -> DataFrame:
    """How many places each term has in the whole index."""

    def work(rows):
        terms = np.frombuffer(b"".join(rows.column("terms").to_pylist()), np.uint64)
        values, n = np.unique(terms, return_counts=True)
        yield batch(term=values.view(np.int64), n=n)

    return by_batch(stored.select("terms"), work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class _Plan:
    """Windows of a block: terms rarest first, by the rarest one."""

    def __init__(self, rows):
        rows = [r for r in rows if r["ordered"]]
        depth = max([len(r["ordered"]) for r in rows], default=0)
        self.terms = np.zeros((len(rows), depth), np.uint64)
        self.offsets = np.zeros((len(rows), depth), np.int64)
        self.many = np.array([len(r["ordered"]) for r in rows], np.int64)
        self.n_words = np.array([r["n_words"] for r in rows], np.int64)
        for k, r in enumerate(rows):
            for d, t in enumerate(r["ordered"]):
                self.terms[k, d] = np.uint64(t["term"] & 0xFFFFFFFFFFFFFFFF)
                self.offsets[k, d] = t["offset"]
        self.window = np.array([r["window"] for r in rows], np.int64)
        self.first = self.terms[:, 0] if depth else np.zeros(0, np.uint64)
        self.order = np.argsort(self.first, kind="stable")
        self.sorted = self.first[self.order]


def _key(doc, term, place):
    return mix(term + mix(doc.astype(np.uint64) * np.uint64(1 << 32) + place.astype(np.uint64)))


def search(stored: DataFrame, plan: _Plan, slack: int = 0) -> DataFrame:
    """The index rows with ``hits`` (first word, end) and numbers of the ``windows`` found, and ``near``: how many
    windows were found only with slack."""
    sent = stored.sparkSession.sparkContext.broadcast(plan)

    def work(rows):
        plan = sent.value
        raw, places = rows.column("terms").to_pylist(), rows.column("places").to_pylist()
        sizes = np.array([len(x) // 8 for x in raw], np.int64)
        term = np.frombuffer(b"".join(raw), np.uint64)
        place = np.frombuffer(b"".join(places), "<i4").astype(np.int64)
        doc = np.repeat(np.arange(len(raw)), sizes)
        present = np.sort(_key(doc, term, place))

        def has(doc, term, at):
            if not len(present):
                return np.zeros(len(doc), bool)
            key = _key(doc, term, at)
            near = np.minimum(np.searchsorted(present, key), len(present) - 1)
            return (present[near] == key) & (at >= 0)

        low, high = np.searchsorted(plan.sorted, term, "left"), np.searchsorted(plan.sorted, term, "right")
        many = high - low
        total = int(many.sum())
        step = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        window = plan.order[np.repeat(low, many) + step]
        where, start = np.repeat(doc, many), np.repeat(place, many)
        start = start - plan.offsets[window, 0] if total else start
        exact, close = start >= 0, np.ones(total, bool)
        for d in range(1, plan.terms.shape[1]):
            here = np.flatnonzero((plan.many[window] > d) & close)
            if not len(here):
                break
            at = start[here] + plan.offsets[window[here], d]
            same = has(where[here], plan.terms[window[here], d], at)
            exact[here] &= same
            around = same.copy()
            for off in range(1, slack + 1):
                for sign in (-off, off):
                    around |= has(where[here], plan.terms[window[here], d], at + sign)
            close[here] &= around
        hits: dict[int, tuple[list, set]] = {}
        for k in np.flatnonzero(exact & close).tolist():
            spans, windows_ = hits.setdefault(int(where[k]), ([], set()))
            spans.append((int(start[k]), int(start[k] + plan.n_words[window[k]])))
            windows_.add(int(plan.window[window[k]]))
        near: dict[int, set] = {}
        for k in np.flatnonzero(close & ~exact).tolist():
            near.setdefault(int(where[k]), set()).add(int(window[k]))
        n = len(raw)
        yield batch(
            row=rows.column("row"), doc_id=rows.column("doc_id"), n_words=rows.column("n_words"),
            hits=pa.array([[{"first": a, "end": b} for a, b in sorted(set(hits[k][0]))] if k in hits else [] for k in range(n)],
                          pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            windows=pa.array([sorted(hits[k][1]) if k in hits else [] for k in range(n)], pa.list_(pa.int64())),
            near=pa.array([len(near.get(k, ())) for k in range(n)], pa.int64()),
        )

    return by_batch(stored, work, "row long, doc_id long, n_words long, hits array<struct<first: long, end: long>>, "
                    "windows array<long>, near long")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slack: int = 2) -> DataFrame:
    """doc_id, n_words, hits, items, near: one row per row of ``docs``."""
    with scratch(docs.sparkSession) as files:
        return files.keep(_contamination(docs, benchmark, width, slack), "contamination")


def _contamination(docs: DataFrame, benchmark: DataFrame, width: int, slack: int) -> DataFrame:
    asked = materialize(windows(benchmark, width), "windows")
    terms = materialize(asked.select(F.explode("terms.term").alias("key")).distinct(), "terms")
    widths = sorted({min(r["n_words"], TERM) for r in asked.select("n_words").distinct().collect()}) or [TERM]
    stored = materialize(
        index(docs, widths, make_filter(terms, terms.count())).select(F.monotonically_increasing_id().alias("row"), "*"),
        "index")
    ordered = (
        asked.groupBy("window").agg(F.first("n_words").alias("n_words"), F.first("terms").alias("terms"))
        .select("window", "n_words", F.size("terms").alias("_many"), F.explode("terms").alias("t"))
        .select("*", F.col("t.term").alias("term"), F.col("t.offset").alias("offset"))
        .join(term_counts(stored), "term")
        .groupBy("window").agg(
            F.first("n_words").alias("n_words"), F.first("_many").alias("_many"),
            F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("ordered"))
        .filter(F.size("ordered") == F.col("_many"))  # a window with a term that never occurs is nowhere
    )
    ordered = materialize(ordered, "query")
    blocks = max(1, -(-ordered.count() // WINDOWS_PER_BLOCK))
    whole = None
    for k in range(blocks):
        found = search(stored, _Plan(ordered.filter(F.pmod(F.hash("window"), F.lit(blocks)) == k).collect()), slack)
        whole = found if whole is None else whole.unionByName(found)
    if blocks > 1:
        whole = whole.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.flatten(F.collect_list("windows")).alias("windows"), F.sum("near").alias("near"))
    whole = materialize(whole, "found")
    # a window's items stay in Spark: however many share one, only numbers of windows were sent around
    items = whole.select("row", F.explode("windows").alias("window")).join(
        asked.select("window", "item").distinct(), "window").groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    return whole.join(items, "row", "left").select(
        "doc_id", "n_words", "hits", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "near")


def summary(found: DataFrame) -> DataFrame:
    """The counts and digest of what was found; spans may overlap."""

    def work(rows):
        hit, digest = [], []
        for spans, items in zip(rows.column("hits").to_pylist(), rows.column("items").to_pylist()):
            n, reach = 0, 0
            for span in spans:
                n += max(0, span["end"] - max(reach, span["first"]))
                reach = max(reach, span["end"])
            hit.append(n)
            digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        yield batch(
            doc_id=rows.column("doc_id"), n_words=rows.column("n_words"), n_hit=pa.array(hit, pa.int64()),
            n_items=pa.array([len(x) for x in rows.column("items").to_pylist()], pa.int64()),
            items_sha256=pa.array(digest, pa.string()), contaminated=pa.array([n > 0 for n in hit], pa.bool_()),
            n_near=rows.column("near"),
        )

    return by_batch(found, work, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                    "contaminated boolean, n_near long")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window.  Rows go one by one, whatever ids they share or lack; all columns stay as
    they are."""
    with scratch(spark) as files:
        rows, _ = numbered(docs, files)
        found = contamination(
            rows.select(F.col("key").alias("doc_id"), "row.text"), table(spark, sf_dir, "benchmark"), slack=0)
        bad = files.keep(found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("bad")), "contaminated")
    return rows.join(bad, rows["key"] == bad["bad"], "left_anti").select("row.*")
