"""Ranked lexical search without a document index: an Aho-Corasick scan of the texts.

All terms of the items form one automaton.  A text is put into a guarded form
(every byte outside a term is a space, A-Z are lower-cased, a space at each
end) and every pattern is a term between two spaces, so the automaton reports
whole terms only, each with its number; counting the numbers gives tf, and a
table from numbers to items says which items they score for.

Two passes over the texts: the first gives N, L and each term's df (one row a
term and task), the second scores and keeps each task's ``k`` best documents of
every item, so neither pass shuffles texts or hits, and nothing about a document
is stored.

What is broadcast is bounded: items are dealt into groups of at most about
``TERM_BYTES`` bytes of terms, and each group has its own automaton and scan.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, table

#: bytes of the terms of one group of items (an item by itself may be longer)
TERM_BYTES = 2 << 20
#: (document, item) scores held at once, and (document, term, item) products
SCORES, PRODUCTS = 1 << 21, 1 << 22
#: (document, term) counts held before they are scored
HITS = 1 << 18
TOP = 50

# --- fixed values: terms are runs of 0-9, A-Z, a-z and everything beyond ASCII ---
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# --- end of fixed values ---

#: byte -> byte of the guarded form: bytes of terms stay (A-Z as a-z), the others become spaces
GUARDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def guarded(text: str | None) -> bytes:
    return b" " + (text or "").encode("utf-8").translate(GUARDED) + b" "


def length_of(form: bytes) -> int:
    """The number of terms of a guarded text: the spaces that a term follows."""
    space = np.frombuffer(form, np.uint8) == 32
    return int(np.count_nonzero(space[:-1] & ~space[1:]))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, terms): the distinct terms of every item, one row an item (repeated ids are joined)."""
    lower = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    terms = F.coalesce(F.regexp_extract_all(lower, F.lit(TERM), 0), F.array().cast("array<string>"))
    return (items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item"), F.explode(terms).alias("term"))
            .distinct().groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")))


class Matcher:
    """The automaton of a group's terms, and from term numbers to items."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.items = np.array([i for i, _ in rows], np.int64)
        self.terms = sorted({t for _, terms in rows for t in terms})
        number = {t: k for k, t in enumerate(self.terms)}
        pairs = sorted((number[t], k) for k, (_, terms) in enumerate(rows) for t in terms)
        self.of_term = np.array([k for _, k in pairs], np.int64)  # items, by term
        self.n_items = np.bincount(np.array([t for t, _ in pairs], np.int64), minlength=len(self.terms))
        self.first = np.cumsum(self.n_items) - self.n_items
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}  # built once by every worker

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for k, t in enumerate(self.terms):
                a.add_word(f" {t} ".encode("utf-8").decode("latin-1"), k)  # a byte is a character
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def counts(self, form: bytes) -> Counter:
        """tf of every term in a text's guarded form."""
        return Counter(map(itemgetter(1), self.automaton.iter(form.decode("latin-1"))))


def _statistics(sent):
    """Per task: documents with terms (term -1), all terms of them (term -2), and every term's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Matcher = sent.value
        df = np.zeros(len(m.terms), np.int64)
        docs = total = 0
        for b in batches:
            for t in b.column("text"):
                form = guarded(t.as_py())
                n = length_of(form)
                docs, total = docs + (n > 0), total + n
                if n:
                    df[list(m.counts(form))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], at])), pa.array(np.concatenate([[docs, total], df[at]]))],
                                         names=["term", "n"])

    return run


class Best:
    """The k best (score, id) of every item so far; equal scores by id, null ids last."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.rows: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4]
        self.held = 0
        self.floor = np.zeros(items, np.int64)  # a lower score can't get in

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        ok = (score > 0) & (score >= self.floor[item])
        self.rows.append((item[ok], score[ok], doc[ok], null[ok]))
        self.held += int(ok.sum())
        if self.held > 4 * self.items * self.k + SCORES:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, score, doc, null = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        begin = np.searchsorted(item, np.arange(self.items))
        keep = np.arange(len(item)) - begin[item] < self.k
        full = np.flatnonzero(np.append(begin[1:], len(item)) - begin >= self.k)
        self.floor[full] = score[begin[full] + self.k - 1]
        self.rows, self.held = [(item[keep], score[keep], doc[keep], null[keep])], int(keep.sum())
        return self.rows[0]


def impacts(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _score(sent, stats, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Matcher = sent.value
        n_docs, total, w = stats.value
        best = Best(len(m.items), k)
        block = max(1, SCORES // max(1, len(m.items)))  # documents scored at once

        def flush(docs: list) -> None:
            ids = np.array([0 if d[0] is None else d[0] for d in docs], np.int64)
            null = np.array([d[0] is None for d in docs], np.int64)
            row = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
            term = np.fromiter((t for d in docs for t in d[2]), np.int64, len(row))
            tf = np.fromiter((c for d in docs for c in d[2].values()), np.int64, len(row))
            length = np.array([100 - 50 + (50 * d[1] * n_docs) // total for d in docs], np.int64)
            points = impacts(w[term], tf, length[row])
            scores = np.zeros(len(docs) * len(m.items), np.int64)
            cost = np.cumsum(m.n_items[term])
            a = 0
            while a < len(term):  # terms to items, a bounded number of products at a time
                before = cost[a - 1] if a else 0
                z = max(a + 1, int(np.searchsorted(cost, before + PRODUCTS, "right")))
                c = m.n_items[term[a:z]]
                at = np.repeat(m.first[term[a:z]] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
                key = np.repeat(row[a:z] * len(m.items), c) + m.of_term[at]
                # exact: sums of whole numbers below 2^53
                scores += np.bincount(key, np.repeat(points[a:z], c), len(scores)).astype(np.int64)
                a = z
            hit = np.flatnonzero(scores)
            best.add(hit % len(m.items), scores[hit], ids[hit // len(m.items)], null[hit // len(m.items)])

        held: list = []
        n_hits = 0
        for b in batches:
            for i, t in zip(b.column("id").to_pylist(), b.column("text")):
                form = guarded(t.as_py())
                hits = m.counts(form)
                if hits:
                    held.append((i, length_of(form), hits))
                    n_hits += len(hits)
                if len(held) >= block or n_hits >= HITS:
                    flush(held)
                    held, n_hits = [], 0
        if held:
            flush(held)
        item, score, doc, null = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(m.items[item]), pa.array(doc, mask=null.astype(bool)), pa.array(score)],
                                         names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP, term_bytes: int = TERM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents of score above 0.

    Null and empty texts have no terms and are no document of the statistics;
    repeated rows are documents of their own; equal scores go by id, null ids
    last; items without an id or without terms have no rows, rows with one item
    id are one item; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 2)
    terms = scratch.put("items", item_terms(items, item_col, item_text_col).withColumn("bytes", size))
    groups = math.ceil((terms.agg(F.sum("bytes")).first()[0] or 0) / term_bytes)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for g in range(groups):
        mine = terms.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).collect()  # about term_bytes
        if mine:
            found = found.unionByName(_search_group(rows, Matcher([(r["item"], r["terms"]) for r in mine]), k, scratch, g))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _search_group(rows: DataFrame, matcher: Matcher, k: int, scratch: Scratch, group: int) -> DataFrame:
    """Every task's k best documents of each of the group's items, as a written table."""
    sc = rows.sparkSession.sparkContext
    sent = sc.broadcast(matcher)
    counts = {r["term"]: r["n"] for r in rows.select("text").mapInArrow(_statistics(sent), "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).collect()}  # one row a term
    n_docs, total = counts.get(-1, 0), counts.get(-2, 0)
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(matcher.terms))], np.int64)
    stats = sc.broadcast((n_docs, total, w))
    return scratch.put(f"best-{group}", rows.mapInArrow(_score(sent, stats, k), "item_id long, doc_id long, score long"))


def op11_lexical(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents WHERE text IS NOT NULL
), c AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark
), tf AS (
  SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (SELECT term, floor(1000 * ln((2 * c.n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, c.n),
p AS (
  SELECT doc_id, term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len * c.n) // c.l)))) AS points
  FROM tf JOIN w USING (term), c
), s AS (SELECT item_id, doc_id, sum(points)::BIGINT AS score FROM p JOIN i USING (term) GROUP BY ALL HAVING sum(points) > 0),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
